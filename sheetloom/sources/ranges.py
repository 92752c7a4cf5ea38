"""Cell ranges such as ``'My Sheet'!B2:F1000``, ``A2557:B`` or ``BK:DN``."""

import re
from dataclasses import dataclass

_RANGE = re.compile(r"^(?:(?:'([^']+)'|([^'!]+))!)?([A-Z]+)([0-9]+)?:([A-Z]+)([0-9]+)?$")


@dataclass(frozen=True)
class CellRange:
    first_col: int
    last_col: int
    first_row: int | None
    last_row: int | None
    sheet: str | None = None

    @property
    def width(self) -> int:
        return self.last_col - self.first_col + 1


def column_number(letters: str) -> int:
    """0 for ``A``, 25 for ``Z``, 26 for ``AA``."""
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def column_letters(number: int) -> str:
    letters = ""
    number += 1
    while number:
        number, rest = divmod(number - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def parse_range(text: str) -> CellRange:
    """Rows may be left open at either end; the sheet name is optional."""
    match = _RANGE.match(text.strip())
    if not match:
        raise ValueError(f"not a cell range: {text!r}")
    quoted, bare, left, top, right, bottom = match.groups()
    found = CellRange(
        column_number(left),
        column_number(right),
        int(top) if top else None,
        int(bottom) if bottom else None,
        quoted or bare,
    )
    if found.width < 1 or (top and bottom and found.last_row < found.first_row):
        raise ValueError(f"range ends before it starts: {text!r}")
    return found
