"""Chat formatting: records of any known layout to canonical turns, turns to a training text with a loss mask.

The fingerprint of a JSON record is a hash of its nested field paths, sorted, as far as some layout knows
them; it selects a declarative mapping to turns ``array<struct<role, text>>``. Further fields do not matter. A record that is
no JSON or of no known layout has NULL turns.

The template writes ``<|im_start|>role``, a line feed, the text and ``<|im_end|>`` with a line feed. Inside roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|``, a line feed in a role ``\\n``; so no text can forge a mark, and reading gives back every character. The loss mask is by segment:
only the texts of assistant turns are under it.

Null roles and texts are empty. Turns with equal numbers are in order of role, then text, so repeated rows stay. An empty table
gives no conversations. A conversation is one record, which must fit in a row. Built-in functions only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
START, END = "<|im_start|>", "<|im_end|>"

# Fixed values. A layout is a list of messages (list field, role field, text field) or one
# field for each turn (role, field); "?" marks fields that may be absent.
LIST_LAYOUTS = [("messages", "role", "content"), ("messages", "role", "text"), ("turns", "role", "text"), ("conversations", "from", "value"), ("conversation", "role", "content")]
FIELD_LAYOUTS = [
    [("system", "system?"), ("user", "prompt"), ("assistant", "completion")],
    [("system", "system?"), ("user", "prompt"), ("assistant", "response")],
    [("system", "system?"), ("user", "question"), ("assistant", "answer")],
    [("system", "system?"), ("user", "instruction"), ("user+", "input?"), ("assistant", "output")],
]
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _known_paths() -> list[str]:
    lists = {p for a, r, t in LIST_LAYOUTS for p in (a, f"{a}[].{r}", f"{a}[].{t}")}
    return sorted(lists | {f.rstrip("?") for layout in FIELD_LAYOUTS for _, f in layout})


def field_paths(record: Column) -> Column:
    """Sorted paths of a variant's fields, and of the fields of objects in its lists, as far as a layout knows them."""
    fields = F.try_variant_get(record, "$", "map<string,variant>")

    def below(entry):
        items = F.try_variant_get(entry["value"], "$", "array<map<string,variant>>")
        names = F.array_distinct(F.flatten(F.transform(items, F.map_keys)))
        return F.coalesce(F.transform(names, lambda n: F.concat(entry["key"], F.lit("[]."), n)), F.array().cast("array<string>"))

    paths = F.concat(F.map_keys(fields), F.flatten(F.transform(F.map_entries(fields), below)))
    return F.array_sort(F.array_intersect(paths, F.array(*map(F.lit, _known_paths()))))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _mappings():
    """``(sorted paths, column of turns)`` for every shape that a layout can take."""
    def value(record, path):
        return F.coalesce(F.try_variant_get(record, f"$.{path}", "string"), F.lit(""))

    def from_list(record, layout):
        name, role, text = layout
        items = F.try_variant_get(record, f"$.{name}", "array<map<string,string>>")
        known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])

        def turn(item):
            own = F.coalesce(F.element_at(item, role), F.lit(""))
            own = F.coalesce(F.element_at(known, own), own) if role == "from" else own
            return F.struct(own.alias("role"), F.coalesce(F.element_at(item, text), F.lit("")).alias("text"))
        return F.transform(items, turn)

    def from_fields(record, present):
        turns = []
        for role, field in present:
            if role == "user+":  # more of the same turn, after an empty line
                extra = value(record, field)
                turns[-1] = (turns[-1][0], F.when(extra == "", turns[-1][1]).otherwise(F.concat(turns[-1][1], F.lit("\n\n"), extra)))
            else:
                turns.append((role, value(record, field)))
        return F.array(*[F.struct(F.lit(r).alias("role"), t.alias("text")) for r, t in turns])

    for layout in LIST_LAYOUTS:
        name, role, text = layout
        yield sorted([name, f"{name}[].{role}", f"{name}[].{text}"]), lambda v, x=layout: from_list(v, x)
    for layout in FIELD_LAYOUTS:
        shapes = [[]]
        for role, field in layout:
            shapes = [s + [(role, field.rstrip("?"))] for s in shapes] + (shapes if field.endswith("?") else [])
        for shape in shapes:
            yield sorted(f for _, f in shape), lambda v, x=shape: from_fields(v, x)


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with ``layout`` (the fingerprint) and ``turns``."""
    parsed = records.withColumn("_v", F.try_parse_json(F.col(record))).withColumn("layout", fingerprint(field_paths(F.col("_v"))))
    turns = F.lit(None).cast(TURNS)
    for paths, mapped in _mappings():
        turns = F.when(F.col("layout") == F.xxhash64(F.lit("\n".join(paths))), mapped(F.col("_v")).cast(TURNS)).otherwise(turns)
    return parsed.withColumn("turns", turns).drop("_v")


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """What ``escape`` was given; doubled backslashes are set apart first, so none is read twice."""
    def plain(part):
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def format_turns(turns: Column) -> Column:
    """Segments ``array<struct<text, loss>>`` whose texts, one after the other, are the training text."""
    def segments(turn):
        role = F.replace(escape(turn["role"]), F.lit("\n"), F.lit("\\n"))
        return F.array(
            F.struct(F.concat(F.lit(START), role, F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), (turn["role"] == "assistant").alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(turns, segments))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(formatted: Column) -> Column:
    """The turns of a training text."""
    def turn(part):
        role = F.substring_index(part, "\n", 1)
        text = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END + "\n"))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    parts = F.split(formatted, START.replace("|", r"\|"), -1)
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def conversation_records(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One JSON record for each conversation of a table of turns: question and answer, or system, question and
    answer, as fields; else a list of messages, every other one under the names ``from`` and ``value``."""
    own = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("content"))
    said = F.transform(F.array_sort(F.collect_list(own)), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    whole = rows.groupBy(F.col(key)).agg(said.alias("_said"))
    names = F.concat_ws("/", F.transform("_said", lambda t: t["role"]))
    text_at = lambda n: F.element_at("_said", n)["content"]
    shown = {"user": "human", "assistant": "gpt", "system": "system"}
    renamed = F.transform("_said", lambda t: F.struct(F.element_at(F.create_map(*[F.lit(x) for p in shown.items() for x in p]), t["role"]).alias("from"), t["content"].alias("value")))
    plain = F.forall("_said", lambda t: t["role"].isin(*shown))
    record = (
        F.when(names == "user/assistant", F.to_json(F.struct(text_at(1).alias("prompt"), text_at(2).alias("completion"))))
        .when(names == "system/user/assistant", F.to_json(F.struct(text_at(1).alias("system"), text_at(2).alias("instruction"), text_at(3).alias("output"))))
        .when(plain & (F.pmod(F.hash(key), F.lit(2)) == 0), F.to_json(F.struct(renamed.alias("conversations"))))
        .otherwise(F.to_json(F.struct(F.col("_said").alias("messages"))))
    )
    return whole.select(key, record.alias("record"))


def format_conversations(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with ``layout``, ``turns``, ``segments`` and ``formatted``."""
    turns = canonical_turns(records, record).withColumn("segments", format_turns(F.col("turns")))
    return turns.withColumn("formatted", formatted_text(F.col("segments")))
