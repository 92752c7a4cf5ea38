"""The pipeline against a plain version of every stage, over documents with planted cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sheetloom.llm import decontamination, langid, minhash, toxicity
from sheetloom.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, over the smallest table and some more rows."""
    docs = table(spark, SF, "documents")
    first = docs.orderBy("doc_id").first()
    bench = table(spark, SF, "benchmark").orderBy("item_id").first()
    half = len(bench["text"].split()) // 2
    moved = " ".join(bench["text"].split()[half:] + ["and", "also"] + bench["text"].split()[:half])
    more = [(90001, first["text"] + " end", "fr"), (90002, first["text"].replace(" ", " \t"), "fr"), (90003, f"Well now {moved} so it is", "en"), (90004, None, "en"), (90005, " .. 12 ", "en")]
    extra = spark.createDataFrame([(i, t, lang, "planted", 0) for i, t, lang in more], "doc_id long, text string, lang string, source string, n_chars long")
    folder = tmp_path_factory.mktemp("sf")
    docs.unionByName(extra.select(*[F.col(c).cast(t) for c, t in docs.dtypes])).write.parquet(str(folder / "documents.parquet"))
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(str(folder / f"{name}.parquet"))
    inputs, at = [], table(spark, str(folder), "documents")
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        inputs.append(at)
        step(spark, at, str(folder)).write.parquet(str(folder / f"stage-{k}"))
        at = spark.read.parquet(str(folder / f"stage-{k}"))
    return str(folder), inputs, at


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    _, inputs, _ = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "decontamination", "packing"]
    assert all(df.columns == inputs[0].columns for df in inputs)


def test_language(stages):
    _, inputs, _ = stages
    before, after = texts(inputs[0]), texts(inputs[1])
    model = langid.fit(inputs[0])
    assert set(after) == {i for i, t in before.items() if langid.letters(t) and model.predict(t)[1] >= langid.REJECT_BELOW}
    assert {90004, 90005}.isdisjoint(after) and len(after) >= 0.97 * len(before)


def test_toxicity(spark, stages):
    folder, inputs, _ = stages
    before, after = texts(inputs[1]), texts(inputs[2])
    model = toxicity.fit(inputs[1], table(spark, folder, "labels"))
    assert set(after) == {i for i, t in before.items() if model.score(t) < 0.5}
    toxic = {r["doc_id"] for r in table(spark, folder, "labels").filter("toxic = 0").collect()} & set(before)
    assert len(toxic & set(after)) >= 0.95 * len(toxic)


def test_near_duplicates(stages):
    _, inputs, _ = stages
    before, after = texts(inputs[2]), texts(inputs[3])
    sets = {i: minhash.shingle_set(t, 5) for i, t in before.items()}
    group = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a]) and len(sets[b]) and
             100 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    assert set(after) == {i for i in before if group[i] == i}
    assert 90002 not in after


def test_decontamination(spark, stages):
    folder, inputs, _ = stages
    before, after = texts(inputs[3]), texts(inputs[4])
    items = [decontamination.words_of(r["text"]) for r in table(spark, folder, "benchmark").collect()]

    def leaks(text):
        """Half of an item's words in runs of five that the text has too."""
        own = decontamination.words_of(text)
        runs = {tuple(own[k:k + 5]) for k in range(len(own) - 4)}
        for item in items:
            covered = {p + d for p in range(len(item) - 4) if tuple(item[p:p + 5]) in runs for d in range(5)}
            if len(covered) >= 0.5 * len(item):
                return True
        return False

    assert set(after) == {i for i, t in before.items() if not leaks(t)}
    assert 90003 not in after


def test_packing(stages):
    _, inputs, last = stages
    before = texts(inputs[4])
    import public_tokenizers
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in last.collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    assert set(got) == set(before)
    for i, pieces in got.items():
        ids = np.frombuffer(b"".join(p for _, p in sorted(pieces)), "<u4").tolist()
        assert ids == full.encode(before[i], add_special_tokens=False).ids + [1]


def test_run_is_the_stages_in_order(spark, stages):
    folder, _, last = stages
    columns = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).select(*columns).collect())) == sorted(map(tuple, last.select(*columns).collect()))
