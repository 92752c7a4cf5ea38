"""The queries with SQL against it, the others against a plain version, on the smallest tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

from sheetloom.llm import html_text, imatch, minhash
from sheetloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"create view {file.stem} as from '{file}'")
    return con


def docs(con):
    return dict(con.execute("select doc_id, text from documents").fetchall())


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    expected = con.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(expected.fetchall(), key=repr)


def test_minhash_against_all_pairs(spark, con):
    sets = {i: minhash.shingle_set(t, 3) for i, t in docs(con).items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and len(sets[a]) and len(sets[b]):
                common = len(np.intersect1d(sets[a], sets[b]))
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    rows = QUERIES["op2_minhash"](spark, SF).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: root(i) for i in ids}
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_packing_holds_every_id_once(spark, con):
    import public_tokenizers
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array(full.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in docs(con).items()}
    rows = QUERIES["op1_packing"](spark, SF).collect()
    seen, windows = {i: [] for i in ids}, {}
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes())
        seen[r["doc_id"]].append((r["start"], r["length"]))
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, pieces in seen.items():
        assert [p for p, _ in sorted(pieces)] == np.cumsum([0] + [n for _, n in sorted(pieces)])[:-1].tolist()
        assert sum(n for _, n in pieces) == len(ids[i])
    for pieces in windows.values():
        pieces.sort()
        assert [p for p, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist()
    assert all(sum(n for _, n in w) <= 2048 for w in windows.values())
    assert sum(sum(n for _, n in w) < 2048 for w in windows.values()) <= 1


def test_toxicity_on_held_out_labels(spark, con):
    labels = dict(con.execute("select doc_id, toxic from labels").fetchall())
    rows = QUERIES["op3_toxicity"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    known = [r for r in rows if r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in known) >= 0.9 * len(known)


def test_language_on_held_out_rows(spark, con):
    lang = dict(con.execute("select doc_id, lang from documents").fetchall())
    rows = QUERIES["op8_language_id"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_imatch_edits(spark, con):
    texts = sorted(docs(con).items())
    rows = {r["doc_id"]: r for r in QUERIES["op4_imatch"](spark, SF).collect()}
    assert len(rows) == len(texts)
    for k, (i, text) in enumerate(texts):
        following, n = texts[(k + 1) % len(texts)][1], len(text)
        edited = text[:n - n // 4] + following[:n // 4]
        assert rows[i]["n_chars"] == n
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    near = np.array([(r["near_edited"], r["near_next"]) for r in rows.values()])
    assert near[:, 0].mean() > 0.3 and near[:, 1].mean() < 0.05


def test_imatch_is_that_of_plain_sets(spark, con):
    """Band, lexicon subsets and likeness by loops over words and bits; equal subsets have equal hashes and others don't."""
    texts = [t for _, t in sorted(docs(con).items())]
    words = [set(re.findall(r"\w+", t.lower())) for t in texts]
    hashed = {w: xxhash.xxh3_64_intdigest(w.encode()) for s in words for w in s}
    seen = Counter(b for s in words for b in {hashed[w] >> 44 for w in s})
    low, high = max(imatch.BAND[0] * len(texts), 1), max(imatch.BAND[1] * len(texts), 2)
    salts = [int(x) for x in imatch._SALTS]

    def subset_rates(h):
        """For each series, at how many rates the term with this hash is in the subset."""
        for salt in salts:
            mixed = (h ^ h >> 31) * salt % 2 ** 64
            mixed ^= mixed >> 32
            yield min((mixed & -mixed).bit_length() - 1 if mixed else 64, imatch.RATES)

    def subsets(text):
        mine = {hashed.setdefault(w, xxhash.xxh3_64_intdigest(w.encode())) for w in re.findall(r"\w+", text.lower())}
        out = {}
        for h in mine:
            if low <= seen[h >> 44] <= high:
                for k, most in enumerate(subset_rates(h)):
                    for rate in range(1, most + 1):
                        out.setdefault((rate, k), set()).add(h)
        return out

    def likeness(a, b):
        by_rate, spots = {}, a.keys() | b.keys()
        for rate in {r for r, _ in spots}:
            met = [s for s in spots if s[0] == rate]
            if len(met) >= imatch.SUBSETS / 2:
                by_rate[rate] = sum(a.get(s) == b.get(s) for s in met) / len(met)
        return max(by_rate.values()) if by_rate else sum(a.get(s) == b.get(s) for s in spots) / max(len(spots), 1)

    rows = [r for _, r in sorted((r["doc_id"], r) for r in QUERIES["op4_imatch"](spark, SF).collect())]
    for k, text in enumerate(texts):
        following, n = texts[(k + 1) % len(texts)], len(text)
        edited = text[:n - n // 4] + following[:n // 4]
        own = subsets(text)
        for column, other in (("near_edited", edited), ("near_next", following)):
            expected = 1.0 if text == other else likeness(own, subsets(other))
            assert rows[k][column] == pytest.approx(expected), (k, column)


def test_leaks_are_those_found_by_reading(spark, con):
    plain = lambda t: " ".join("".join(c if c.isalnum() or c == "_" else " " for c in t.lower()).split())
    items = {i: plain(t) for i, t in con.execute("select item_id, text from benchmark").fetchall()}
    found = {(d, i) for d, t in docs(con).items() for i, x in items.items() if f" {x} " in f" {plain(t)} "}
    rows = QUERIES["op6_decontamination"](spark, SF).collect()
    assert found and {(r["doc_id"], r["item_id"]) for r in rows} == found


def test_warc_reads_back(spark, con):
    pages = con.execute("select page_id, html from pages order by page_id").fetchall()
    first = {}
    for i, text in pages:
        first.setdefault(text, i)
    rows = {r["page_id"]: r for r in QUERIES["op7_warc"](spark, SF).collect()}
    assert len(rows) == len(pages)
    for i, text in pages:
        assert rows[i]["payload_bytes"] == len(text.encode())
        assert rows[i]["payload_digest"] == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
        assert (rows[i]["record_type"], rows[i]["refers_to"]) == (("response", None) if first[text] == i else ("revisit", first[text]))


def test_html_text(spark, con):
    """Main text is the title and the lines of the document that a page shows."""
    shown = con.execute(r"select page_id, d.text from pages join documents d on doc_id = try_cast(regexp_extract(url, '/[a-z]{2}/([0-9]+)', 1) as bigint)").fetchall()
    rows = {r["page_id"]: r for r in QUERIES["op9_html_text"](spark, SF).collect()}
    lines = lambda t: "\n".join(x for x in (" ".join(y.split()) for y in t.split("\n")) if x)
    for i, text in shown:
        assert rows[i]["text"].split("\n", 1)[1] == lines(text)
        assert rows[i]["n_chars"] == len(rows[i]["text"])
    assert html_text.main_text(None, set()) == ""
