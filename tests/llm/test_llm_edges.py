"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import gzip
import re
import sys
import timeit

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import (
    chat, components, decontamination, html_text, imatch, langid, minhash, packing, toxicity, url_reputation, warc,
)
from sheetloom.staging import new_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, doc string, score double, content string, target int"
LONG = " ".join(f"word{k}" for k in range(30_000))
TEXTS = [(1, "the cat sat on the mat today"), (2, None), (3, ""), (4, "!!! ... 123"), (5, LONG), (6, LONG), (7, "the cat sat on the mat today"), (7, "the cat sat on the mat today"), (None, "no id at all here")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None, None, "a", "b", 0.5, "c", 1) for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_langid(spark, docs, none):
    rows = langid.predict_held_out(docs).collect()
    assert len(rows) == len(TEXTS)
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (2, 3, 4))
    assert by[1]["lang_pred"] == "en"
    assert langid.predict_held_out(none).count() == 0
    assert langid.keep_known(docs, langid.fit(docs)).columns == docs.columns
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.predict_held_out(unlabelled).collect()} == {"und"}


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, 0, 1), (7, 1, 0), (7, None, 1), (2, 0, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    rows = toxicity.score_held_out(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_held_out(none, labels).count() == 0
    assert {r["score"] for r in toxicity.score_held_out(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.keep_clean(docs, labels).columns == docs.columns


def test_pairs_matter():
    """Neither of two terms tells anything alone; together they do."""
    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(40)]
    texts, y = [], []
    for k in range(600):
        a, b = k % 2, k // 2 % 2
        texts.append(" ".join([*rng.choice(words, 4), *["insult"] * a, *["group"] * b]))
        y.append(float(a and b))
    size = 1 << toxicity.BITS
    model = toxicity.FactorizationMachine(np.ones(size, np.float32), 0.0, np.zeros(size, np.float32), rng.normal(0, 0.02, (size, toxicity.FACTORS)).astype(np.float32))
    toxicity.learn(model, [toxicity.term_buckets(t) for t in texts], np.array(y), epochs=30, rate=0.1)
    score = lambda t: model.margin(toxicity.term_buckets(t))
    assert score("w1 w2 insult group") > 0 > max(score("w1 w2 insult"), score("w1 w2 group"))


def test_minhash(spark, docs, none):
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(docs, words=3, num=85).collect()}
    assert {i: r["component_id"] for i, r in rows.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 1, None: None}
    assert rows[2]["n_shingles"] == rows[3]["n_shingles"] == 0 and rows[4]["n_shingles"] == 1
    assert sorted(i for i, r in rows.items() if not r["kept"]) == [6, 7]
    assert minhash.near_duplicates(none).count() == 0
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) - 3


def test_minhash_hot_group(spark):
    """A group of near copies that crosses several blocks, and a chain of links that no centre reaches."""
    rng = np.random.default_rng(3)
    base = [f"b{k}" for k in range(120)]
    texts = []
    for k in range(700):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 4), replace=False):
            words[at] = f"x{k}_{at}"
        texts.append(" ".join(words))
    for step in range(1, 12):
        texts.append(" ".join([f"y{k}" for k in range(4 * step)] + base[4 * step:]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = [minhash.shingle_set(t, 3) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            if root(a) != root(b):
                common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, words=3, num=85).collect()}
    assert got == {i: root(i) for i in range(len(texts))}


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100, 102: 100}
    assert components.components(edges.limit(0)).count() == 0


def test_components_end_with_stars(spark, monkeypatch):
    """No step only to see that nothing changes: edges are written once to begin with and once for the one step that a star takes."""
    written, plain = [], components.stage
    monkeypatch.setattr(components, "stage", lambda df, label: written.append(label) or plain(df, label))
    star = spark.createDataFrame([(0, k) for k in range(1, 9)] + [(9, 10)], "a long, b long")
    assert {r["node"]: r["component"] for r in components.components(star).collect()} == {**{k: 0 for k in range(1, 9)}, 10: 9}
    assert len(written) == 2


def test_features_reach_the_driver_as_bytes(spark, docs, monkeypatch):
    """Not as arrays, of which each number would be an object there."""
    fetched, plain = [], type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda self: fetched.append(dict(self.dtypes)) or plain(self))
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 8)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels).known and langid.fit(docs).labels == ["en"]
    assert [f["buckets"] for f in fetched] == ["binary", "binary"] and fetched[1]["counts"] == "binary"


def test_imatch(spark, docs, none):
    rows = imatch.fingerprint_edits(docs).collect()
    assert len(rows) == len(TEXTS)
    prints = {}
    for r in rows:
        prints.setdefault(r["doc_id"], r["fingerprint"])
    assert prints[1] == prints[7] and prints[5] == prints[6] and prints[2] == prints[3] == ""
    assert imatch.fingerprint_edits(none).count() == 0
    alone = imatch.fingerprint_edits(docs.filter("doc_id = 1")).first()
    assert alone["near_next"] == 1.0
    assert imatch.likeness("", "") == 1.0 and imatch.likeness("", alone["fingerprint"]) == 0.0


def test_letters():
    """Fractions, raised and circled numbers are no letters; Chinese numerals are."""
    assert [langid.letters(t) for t in ("½ ² ①", "a½b", "一二 Ⅷ ab", None, "1_2")] == ["", "a b", "一二 ab", "", ""]


def test_letters_are_found_fast():
    """As by a pattern of all that is no letter, and in less time a character than trying such a pattern takes."""
    numbers = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
    pattern = re.compile(rf"[\W\d_{numbers}]+")
    every = "".join(f"a{chr(c)}" for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    assert langid.letters(every) == pattern.sub(" ", every.lower()).strip()
    for text in (" a", "a ", "  a--b  ", "-", "\ud800x", "ΑΣ Σ", "İ1ı", "😀 ok 😀"):
        assert langid.letters(text) == pattern.sub(" ", text.lower()).strip()
    text = "Ein Satz, der länger ist als andere. " * 3000
    timed = lambda run: min(timeit.repeat(run, number=1, repeat=3))
    assert timed(lambda: langid.term_counts(text)) < timed(lambda: pattern.sub(" ", text.lower()))


def test_reordered_passage(spark, docs, none):
    first, second = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine"
    bench = spark.createDataFrame([(9, f"{first}. {second}"), (9, f"{first}. {second}"), (10, None), (11, "too short"), (12, LONG[:400])], "item_id long, text string")
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(20, f"Before {second.upper()}, and later {first}!"), (21, first[:20])], "doc_id long, text string"))
    rows = decontamination.find_leaks(more, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(5, 12), (6, 12), (20, 9), (20, 9)]
    assert {r["tiles"] for r in rows if r["doc_id"] == 20} == {2}
    in_blocks = decontamination.find_leaks(more, bench, block_chars=50).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in in_blocks) == sorted((r["doc_id"], r["item_id"]) for r in rows)
    assert decontamination.find_leaks(none, bench).count() == 0 and decontamination.find_leaks(docs, bench.limit(0)).count() == 0
    kept = decontamination.keep_clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) - 2


def test_short_items_and_scripts_without_blanks(spark):
    docs = spark.createDataFrame([(1, "Well, what is the Capital? asked they"), (2, "他说机器学习模型需要大量数据才行"), (3, "what is a capital, the"), (4, "机器人很好"), (5, ""), (6, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "what is the capital"), (2, "机器学习模型需要大量数据"), (3, "they"), (4, "人很好"), (5, ""), (6, "asked they !")], "item_id long, text string")
    found = lambda **more: {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, bench, **more).collect()}
    assert found() == {(1, 1), (2, 2), (4, 4)}
    assert found(min_words=1) == {(1, 1), (2, 2), (4, 4), (1, 3), (1, 6)}
    assert sorted(r["doc_id"] for r in decontamination.keep_clean(docs, bench).collect()) == [3, 5, 6]


def test_tiles_do_not_overlap():
    # The item a b c d e f is in the document as c d e f a b c: the longest match comes first.
    item, doc = list("abcdef"), list("cdefabc")
    hits = [(p, q) for p in range(5) for q in range(6) if item[p:p + 2] == doc[q:q + 2]]
    assert sorted(decontamination.tile(hits, 2, 6)) == [(0, 4, 2), (2, 0, 4)]


def test_packing(spark, docs, none):
    rows = packing.pack(docs).collect()
    total = {}
    for r in rows:
        total.setdefault(r["doc_id"], []).append(r)
    assert set(total) == {1, 2, 3, 4, 5, 6, 7, None}
    assert [(r["start"], r["length"], r["doc_tokens"]) for r in total[2]] == [(0, 1, 1)]
    assert sum(r["length"] for r in total[5]) == total[5][0]["doc_tokens"]
    assert packing.pack(none).count() == 0


def test_neighbours_fill_a_window():
    """A seed's window gets the unused document that shares its rare terms, not the next one in order."""
    terms = [np.array([1, 2, 3]), np.array([7, 8, 9]), np.array([1, 2, 4])]
    windows = packing.pack_shard(np.array([6, 5, 4]), terms, [np.ones(3)] * 3, np.ones(10), window=10)
    assert windows[0] == [(0, 0, 6), (2, 0, 4)]


@pytest.mark.parametrize("n", [400, 1600])
def test_best_neighbours_share_a_shard(spark, n):
    """Against brute force, with about as many shards as a hundredth of the documents; copies are always together."""
    random = np.random.default_rng(5)
    common = [f"usual{k}" for k in range(60)]
    texts = [" ".join([f"topic{k // 4}x{w}" for w in random.choice(40, 16, False)] + list(random.choice(common, 40))) for k in range(n)]
    texts += texts[:20]
    sets = [np.unique(packing.term_hashes(t), return_counts=True) for t in texts]
    df = np.bincount(np.concatenate([s[0] for s in sets]), minlength=1 << packing.TERM_BITS)
    idf = np.where((df > 1) & (df <= packing.COMMON * len(texts)), np.log(1 + (len(texts) - df + 0.5) / (df + 0.5)), 0)
    index = packing.Postings([s[0] for s in sets], [s[1] for s in sets], idf)
    best = []
    for k, (terms, _) in enumerate(sets):
        score = index.scores(terms)
        score[k] = 0
        best.append(int(score.argmax()))
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), window=64, shard_chars=sum(map(len, texts)) * 100 // len(texts)).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r["doc_id"], set()).add(r["sequence_id"] >> 24)
    assert len(set.union(*shards.values())) >= n // 200
    assert np.mean([shards[k] == shards[b] for k, b in enumerate(best)]) >= 0.85
    assert all(shards[k] == shards[n + k] for k in range(20))


def test_texts_are_shuffled_without_ids_and_terms(spark, tmp_path):
    """What goes to the shards, by way of the join and in it, is text: its ids and terms are made where it is packed."""
    frame = spark.createDataFrame([(k, f"alpha beta{k % 7} gamma{k % 5} delta{k}") for k in range(200)], "doc_id long, text string")
    plan = packing.pack(frame, shard_chars=1000)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "broadcast" not in plan
    below = plan[plan.index("RepartitionByExpression"):]
    assert "content" in below and "ids" not in below and "MapInPandas" not in below


def test_ranges_need_no_texts(spark, tmp_path):
    """Spark makes ranges in a run of its own of all that goes to them; texts go by a number that was made from places alone."""
    frame = spark.createDataFrame([(k, f"alpha beta{k % 7} gamma{k % 5} delta{k}") for k in range(200)], "doc_id long, text string")
    plan = packing.pack(frame, shard_chars=1000)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [part#") == 1 == plan.count("RepartitionByExpression")


def test_terms_take_little_room():
    terms, times = np.array([0, 5, 65535, 65536, 200_000, (1 << packing.TERM_BITS) - 1]), np.array([1, 2, 300, 65535, 1, 1], np.uint16)
    for k in (0, 1, 6):
        back = packing.unflat(*packing.flat(terms[:k], times[:k]))
        assert back[0].tolist() == terms[:k].tolist() and back[1].tolist() == times[:k].tolist()
    assert sum(map(len, packing.flat(terms, times))) == 16 + 4 * len(terms)


def test_a_task_takes_several_shards(spark):
    """Beginning a task took a third of the search's time when each shard had its own."""
    frame = spark.createDataFrame([(k, f"alpha beta{k % 7} gamma{k % 5} delta{k}") for k in range(200)], "doc_id long, text string")
    plan = packing.pack(frame, shard_chars=1000)._jdf.queryExecution().optimizedPlan().toString()
    shards = -(-4 * sum(len(r["text"]) + 1 for r in frame.collect()) // 3000)
    assert shards > 4 and re.findall(r"RepartitionByExpression \[part#\d+\], (\d+)", plan) == [str(-(-shards // packing.SHARDS_PER_TASK))]
    assert packing.SHARDS_PER_TASK > 1


@pytest.mark.parametrize("pairs", [200, 1 << 17])
def test_scores_of_all_for_all(monkeypatch, pairs):
    """Terms in equally many documents are scored together, as each document's terms alone are."""
    random = np.random.default_rng(4)
    terms = [np.unique(np.append(random.choice(12, 4), random.choice(900, 20))) for _ in range(60)] + [np.empty(0, np.int64), np.array([5000])]
    index = packing.Postings(terms, [random.integers(1, 4, len(t)) for t in terms], random.random(1 << packing.TERM_BITS) + 0.1)
    monkeypatch.setattr(packing, "_PAIRS", max(pairs, int(index.df.max()) ** 2))
    score = packing.square_scores(index, np.arange(len(index.df)))
    for k, wanted in enumerate(terms):
        others = np.arange(len(terms)) != k  # a term of one document alone is not scored
        assert np.allclose(score[k, others], index.scores(wanted)[others])


def test_parts_are_all_rows_in_order():
    frames = [pd.DataFrame({"a": range(k, k + n)}) for k, n in ((0, 5), (5, 0), (5, 4), (9, 1))]
    found = [part["a"].tolist() for part in packing.parts(iter(frames), 2)]
    assert max(map(len, found)) == 2 and sum(found, []) == list(range(10))


def test_many_texts_have_the_coordinates_of_each():
    random = np.random.default_rng(6)
    lots = random.random(1 << packing.TERM_BITS)
    lots[7] = lots[8]
    texts = [np.array(t, np.int64) for t in ([], [3], [7, 8], [7, 8, 9, 10])] + [np.unique(random.choice(5000, 30)) for _ in range(50)] + [np.empty(0, np.int64)]
    for found, key in zip(texts, packing.coordinates(texts, lots)):
        expected = 0
        least = found[np.argsort(lots[found], kind="stable")[:packing.COORDINATES]].tolist()
        for term in least + [0] * (packing.COORDINATES - len(least)):
            expected = expected << packing.TERM_BITS | term
        assert key == expected
    assert packing.coordinates([], lots) == [] and packing.coordinates([texts[0]], lots) == [0]


def test_many_texts_have_the_terms_of_each(monkeypatch):
    monkeypatch.setattr(packing, "_CHUNK", 9)
    texts = ["", "One two one", "  ", "", "Grüße, ΑΣ b\nc", "x" * 30, ""]
    found = list(packing.words_of(texts))
    assert [t for t, _ in found] == texts
    assert all(a.tolist() == packing.term_hashes(t).tolist() for t, a in found)


@pytest.mark.parametrize("cells", [200, 1 << 20])
def test_best_neighbours_are_those_of_all_scores(monkeypatch, cells):
    random = np.random.default_rng(3)
    terms = [np.unique(np.append(random.choice(40, 5), random.choice(3000, 20))) for _ in range(150)] + [np.array([9000]), np.array([9001])]
    counts = [random.integers(1, 4, len(t)) for t in terms]
    nodes = np.arange(len(terms)) // 2 * 2  # pairs with one node are no neighbours
    index = packing.Postings(terms, counts, random.random(1 << packing.TERM_BITS) + 0.1)
    monkeypatch.setattr(packing, "_CELLS", cells)
    best, top = packing.best_neighbours(index, nodes)
    for k, wanted in enumerate(terms):
        score = index.scores(wanted)
        score[nodes == nodes[k]] = 0
        assert abs(top[k] - score.max()) < 1e-4 and abs(score[best[k]] - score.max()) < 1e-4
    assert top[-1] == top[-2] == 0


def test_texts_are_tokenized_at_once(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path
    texts = ["", " ", "  a  b ", "a \n\n b\t c", "x\u00a0y  z", "q \u2003\u3000w \x85e", "don't  stop'll 'tis rock'n'roll'", "<|endoftext|> a", "a  ", "b", " c", "c1d2 e_f\n", "中文 没有 空格。", "a\x00", " a\x00", "Äé ß 1 !!!\u3000 "]
    full = Tokenizer.from_file(path("byte_bpe_50k.json"))
    right = [full.encode(t, add_special_tokens=False).ids for t in texts]
    own = packing.Tokens(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = lambda: [np.frombuffer(x, np.uint16).tolist() for x in own.encode_all(texts)]
    assert ids() == right and ids() == right
    monkeypatch.setattr(packing, "_KNOWN", 3)  # the table begins anew each time
    monkeypatch.setattr(packing, "_CHUNK", 4)
    assert ids() == right
    own.bytes = own.bytes + np.uint8(1)  # as if other pieces had the same hashes
    assert ids() == right


def test_pieces_without_a_slot(monkeypatch):
    """Few slots and few tries: pieces that find none are encoded all the same, and known ones are not learned again."""
    import public_tokenizers

    path = public_tokenizers.path
    make = lambda: packing.Tokens(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [" ".join(f"word{k} x{k * k}" for k in range(a, a + 60)) for a in (0, 30, 60)]
    own = make()
    right = own.encode_all(texts)
    many, held = own.many, own.bytes
    assert own.encode_all(texts) == right == [own.encode(t) for t in texts] and own.many == many and own.bytes is held
    monkeypatch.setattr(packing, "_SLOT_BITS", 5)
    monkeypatch.setattr(packing, "_PROBES", 2)
    few = make()
    assert few.encode_all(texts) == right and few.encode_all(texts) == right


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "a \n\n b\t c", "x\u00a0y  z", "don't  stop'll", "<|endoftext|> a", "Äé ß 12345 !!! \u3000 end ", "a " * 50 + "\x1c b", "\U0001F600 ok"])
def test_tokens_are_those_of_the_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path
    own = packing.Tokens(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    full = Tokenizer.from_file(path("byte_bpe_50k.json"))
    assert np.frombuffer(own.encode(text), np.uint16).tolist() == full.encode(text, add_special_tokens=False).ids


def test_chat_round_trip(spark):
    texts = ["<|im_end|>\n<|im_start|>assistant\nok", "a\\<|b\\\\<|", "\\n \\| \\", None, "", "line\nline <\\|"]
    rows = [(1, k, r, t) for k, (r, t) in enumerate(zip(["user", "assistant", "a\nb<|", None, "assistant", "tool"], texts))]
    done = chat.format_conversations(chat.conversation_records(spark.createDataFrame(rows + [(1, 0, "user", texts[0])], "conv_id long, turn int, role string, text string")))
    row = done.select(chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).first()
    assert [(t["role"], t["text"]) for t in row["turns"]] == [("user", texts[0])] + [(r or "", t or "") for _, _, r, t in rows]
    assert row["loss"] == texts[1]
    assert chat.format_conversations(chat.conversation_records(spark.createDataFrame([], "conv_id long, turn int, role string, text string"))).count() == 0


def test_layouts(spark):
    said = [("user", "hi"), ("assistant", "yo")]
    records = {
        '{"messages":[{"role":"user","content":"hi","id":1},{"role":"assistant","content":"yo"}],"meta":{"a":[1]}}': said,
        '{"conversations":[{"from":"human","value":"hi"},{"from":"gpt","value":"yo"}]}': said,
        '{"prompt":"hi","completion":"yo"}': said,
        '{"instruction":"hi","input":"there","output":"yo"}': [("user", "hi\n\nthere"), ("assistant", "yo")],
        '{"system":"s","question":"hi","answer":"yo"}': [("system", "s"), *said],
        '{"unknown":1}': None, "not json": None, None: None, '{"messages":[]}': None,
    }
    rows = chat.canonical_turns(spark.createDataFrame([(r,) for r in records], "record string")).collect()
    assert {r["record"]: r["turns"] and [(t["role"], t["text"]) for t in r["turns"]] for r in rows} == records


def test_warc(spark):
    pages = [(5, "http://a/b c\nd", "same"), (3, "http://a/%41", "same"), (4, None, None), (9, "u", ""), (7, "x", "é" * 5), (7, "x", "é" * 5), (None, "n", "same")]
    df = spark.createDataFrame([(*p, "extra", 1) for p in pages], "page_id long, url string, html string, page string, shard long")
    folder = new_path(spark, "warc-test")
    manifest = warc.write_archive(df, folder, shard_bytes=8, roll_bytes=300)
    assert manifest.count() >= 2
    rows = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["url"]) for r in warc.read_archive(spark, folder).collect()), key=repr)
    assert rows == sorted([
        (3, "response", None, 4, "http://a/%41"), (5, "revisit", 3, 4, "http://a/b c\nd"), (4, "response", None, 0, None), (9, "revisit", 4, 0, "u"),
        (7, "response", None, 10, "x"), (7, "revisit", 7, 10, "x"), (None, "response", None, 4, "n"),
    ], key=repr)
    again = new_path(spark, "warc-test")
    other = warc.write_archive(df.repartition(5), again, shard_bytes=8, roll_bytes=300)
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, manifest.collect()))
    small = new_path(spark, "warc-test")
    warc.write_archive(df, small, min_payload=5)
    assert {(r["page_id"], r["record_type"]) for r in warc.read_archive(spark, small).collect() if r["page_id"] != 7} == {(i, "response") for i in (3, 4, 5, 9, None)}
    empty = new_path(spark, "warc-test")
    assert warc.write_archive(df.limit(0), empty).count() == 0 and warc.read_archive(spark, empty).count() == 0


def test_warc_members_are_whole_records():
    record = warc.page_record(1, "http://h/", b"hello", warc.digest_of(b"hello"), None, 0)
    assert gzip.decompress(gzip.compress(record, mtime=0)).endswith(b"\r\n\r\nhello\r\n\r\n")


PAGE = """<html><head><title>T</title></head><body><header class="site"><ul class=menu><li>Home</ul></header>
<div id="cookie-notice">We use cookies</div><div class=layout><aside>side</aside><article><header><h1>Ti&amp;tle</h1></header>
<p>One <b>two<br>three<p>Four &lt;five&gt; a < b<ul><li>x<li>y</ul><form><input name=q><button>Go</button></form>
<script>var a = "</p>";</script><div class="share-buttons"><a href="#">Share</a></div><!-- c --></article></div>
<section class="comments"><article>first!</article></section><footer>&copy; me</footer></body>"""


def test_html():
    assert html_text.main_text(PAGE, set()) == "Ti&tle\nOne two three\nFour <five> a < b\nx\ny"
    assert html_text.main_text("", set()) == "" and html_text.main_text("plain  text", set()) == "plain text"
    assert html_text.main_text("<p>a<p>b<script>never closed", set()) == "a\nb"
    assert html_text.main_text("<div>" * 5000 + "deep", set()) == "deep"


@pytest.mark.parametrize("page, text", [
    ("<article><p>one</p><svg width=1 /><p>two</p></article>", "one\ntwo"),
    ("<article><p>one <svg><title/><path d='M0'/><text>drawn</text></svg> two</p><svg></svg><p>three</p></article>", "one two\nthree"),
    ("<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p><math/><p>two</p>", "let x=1 be\ntwo"),
    ("<p>a<object data=x>fallback</object></p><svg><g><p>left open</p>", "afallback\nleft open"),
    ("<p>a<noscript><p>b<iframe src=x><p>c", "a\nb\nc"),
])
def test_html_elements_end_where_they_end(page, text):
    assert html_text.main_text(page, set()) == text


def test_html_templates(spark):
    pages = [(k, f"http://H{h}.example.com/{k}", f"<div class=x><p>Welcome to us</p></div><p>Own text {k}</p><div>{'same on some' if k < 3 else k}</div>") for h in (1, 2) for k in range(20)]
    pages += [(99, None, None), (98, "http://h1.example.com/", None), (97, "http://rare.example.com", "<p>Welcome to us</p>")]
    rows = html_text.extract(spark.createDataFrame([(*p, "t", "h") for p in pages], "page_id long, url string, html string, text string, host string")).collect()
    texts = {(r["page_id"], r["url"]): r["text"] for r in rows}
    assert len(rows) == len(pages)
    assert texts[(7, "http://H1.example.com/7")] == "Own text 7\n7"
    assert texts[(1, "http://H2.example.com/1")] == "Own text 1\nsame on some"
    assert texts[(99, None)] == "" and texts[(97, "http://rare.example.com")] == "Welcome to us"
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_copies_are_no_template(spark):
    """Six copies of an article keep it, though each has a menu that goes; a notice on 5 % of a large host's pages goes."""
    story = "".join(f"<p>Paragraph {w} tells what happened there in some detail.</p>" for w in ("one", "two", "three", "four"))
    menu = "<div><ul><li>Start page</li><li>All news</li></ul></div>"
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    pages = [(k, f"http://copies.example.com/?session={k}", f"<body>{menu}<div>{story}</div></body>") for k in range(6)]
    pages += [(100 + k, f"http://copies.example.com/{k}", f"<body>{menu}<div><p>Story {w} is another one.</p></div></body>") for k, w in enumerate(words[:8])]
    pages += [(1000 + k, f"http://large.example.com/{k}", f"<body>{'<div>Section notice</div>' if k < 10 else ''}<p>Page {w} says {w} and {w}.</p></body>") for k, w in enumerate(words)]
    texts = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(texts[k].count("\n") == 3 and texts[k].startswith("Paragraph one") for k in range(6))
    assert all(texts[100 + k] == f"Story {w} is another one." for k, w in enumerate(words[:8]))
    assert all(texts[1000 + k] == f"Page {w} says {w} and {w}." for k, w in enumerate(words))


def test_html_recurrence_in_main_content(spark):
    """A notice in the main element of all pages goes, a heading on some of them stays; teasers are not the page."""
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40)]
    pages = [(k, f"http://wrapped.example.com/{k}", f"<main><div>We value what you read</div><p>Page {w} tells of {w}.</p>{'<h2>Sources</h2>' if k < 12 else ''}<p>End of {w}.</p></main>") for k, w in enumerate(words)]
    pages += [(100, "http://teasers.example.com/", "<body><div><p>The story itself, which is much longer than all that follows.</p></div><article>Read on</article></body>")]
    texts = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(texts[k] == f"Page {w} tells of {w}.\n" + ("Sources\n" if k < 12 else "") + f"End of {w}." for k, w in enumerate(words))
    assert texts[100].startswith("The story itself")


@pytest.mark.parametrize("page, text", [
    ('<article><p>One.</p><section id="related-work"><h2 id="navigation">Two</h2></section><p class="notice">Three.</p><section id="social-impact">Four</section></article>', "One.\nTwo\nThree.\nFour"),
    ('<body><div class="content no-sidebar"><p>All the text</p></div><div class="ad">Buy</div></body>', "All the text"),
    ('<body class="menu-closed"><div class="with-sidebar"><p>All the text</p></div></body>', "All the text"),
    ('<form id="aspnetForm"><div><h2 id="navigation">Finding it</h2><p>All the text</p></div></form>', "Finding it\nAll the text"),
    ('<article><p>The text of it.</p><div class="related"><a href="/a">Other</a></div></article>', "The text of it."),
])
def test_html_names_alone_drop_no_text(page, text):
    assert html_text.main_text(page, set()) == text


LONG = "".join(f"<p>Reader {k} has a good deal to say about this.</p>" for k in range(9))


@pytest.mark.parametrize("page, text", [
    (f'<article><h1>Title</h1><p>Short.</p></article><div class="comments">{LONG}</div>', "Title\nShort."),
    (f'<article><h1>Title</h1><p>Short.</p></article><div id="comments"><ol><li><article class="comment">{LONG}</article></li></ol></div>', "Title\nShort."),
    (f'<article><h1>Title</h1><p>Short.</p></article><section class="comments"><article>{LONG}</article></section>', "Title\nShort."),
    (f'<div><h1>Title</h1><p>Short.</p></div><div class="comments">{LONG}</div>', "Title\nShort."),
    (f'<article><p>Short.</p></article><footer>{LONG}</footer>', "Short."),
    (f'<article><p>Short.</p><section class="comments" id="comments">{LONG}</section></article>', "Short."),
    ('<article><p>Text.</p><span class="ad">Buy</span><div class="ad">Buy</div><div class="sidebar">See</div><div class="cookie-notice">We use</div></article>', "Text."),
    ('<article><p>Text.</p><div hidden="">x</div><div hidden="hidden">y</div><div hidden>z</div><p data-hidden>Kept.</p><p title="not hidden">So too.</p></article>', "Text.\nKept.\nSo too."),
    ('<article><header><div><h1>Title</h1></div></header><p>Text.</p></article>', "Title\nText."),
    ('<header><div><h1>Title</h1></div></header><div><p>Text.</p></div>', "Title\nText."),
    ('<header><div><h1>Site</h1></div><nav>All</nav></header><div><p>The text.</p></div>', "The text."),
    # What is nothing but such a container keeps its text.
    ('<h1>Thread</h1><div class="comments"><p>One says this.</p><p>Another that.</p></div>', "Thread\nOne says this.\nAnother that."),
    ('<div class="sidebar"><main><p>All the text</p></main></div><p>Below</p>', "All the text"),
    ('<div><pre>x = 1 <span class="comment"># one</span></pre></div>', "x = 1 # one"),
    ('<form><p>All the text of the page</p></form><p>Below</p>', "All the text of the page\nBelow"),
])
def test_html_what_certainly_is_no_content(page, text):
    assert html_text.main_text(page, set()) == text


def test_html_long_comments_that_do_not_recur(spark):
    """Thirty pages of one host with comments longer than the article, all different or all the same."""
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(30)]
    same = [(k, "http://same.example.com/", f"<article><h1>On {w}</h1><p>Page {w} tells of {w}.</p></article><div class='comments'>{LONG}</div>") for k, w in enumerate(words)]
    other = [(100 + k, "http://other.example.com/", page.replace("Reader", f"Reader {w}")) for (k, _, page), w in zip(same, words)]
    texts = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(same + other, "page_id long, url string, html string")).collect()}
    assert all(texts[k] == texts[100 + k] == f"On {w}\nPage {w} tells of {w}." for k, w in enumerate(words))


def test_url_rules_and_reputation(spark):
    urls = {
        1: "http://EXAMPLE.net/en/x", 2: "http://a.example.net/fr/", 3: "https://b.example.com/de/1?q", 4: "https://b.example.com/den", 5: "x://y.org/fr/#z",
        6: None, 7: "no scheme", 8: "http://notexample.net", 9: "http://bad.test/1", 10: "http://bad.test/2", 11: "http://good.test:80/", 12: "http://Ünd.test",
    }
    pages = spark.createDataFrame([(k, u, "v") for k, u in urls.items()] + [(100 + k, f"http://bad.test/{k}", "v") for k in range(60)] + [(200 + k, f"http://good.test/{k}", "v") for k in range(60)], "page_id long, url string, verdict string")
    outcomes = spark.createDataFrame([(100 + k, True) for k in range(60)] + [(200 + k, False) for k in range(60)] + [(1, None), (None, True)], "page_id long, bad boolean")
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.judge(pages, outcomes).collect()}
    assert rows[1] == ("example.net", "/en/x", "example.net/en/", "allow") and rows[2][2:] == ("net/", "block")
    assert rows[3][2:] == ("example.com/de/", "block") and rows[4][2:] == (None, "allow") and rows[5] == ("y.org", "/fr/", "org/fr/", "allow")
    assert rows[6] == rows[7] == ("", "", None, "allow") and rows[8] == ("notexample.net", "", None, "allow")
    assert rows[9][3] == rows[10][3] == "block" and rows[11][3] == "allow" and rows[12][0] == "Ünd.test"
    assert url_reputation.judge(pages.limit(0), outcomes.limit(0)).count() == 0
