"""What operators keep in workers and move between them."""

import random

import public_tokenizers

from conftest_llm import prose
from quayside.llm import common, jaccard, packing, substrings

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_by_words():
    r = random.Random(1)
    odd = ["", " ", "\n", "a b", "a  b", " a", "a ", "a\n\nb", "a\tb", "é ü.", "x\x1cy", "a\x85b", "<|endoftext|> a b", "日本 語", "a . ,"]
    some = ["".join(r.choice("aé .,\n'1Z🙂\t日") for _ in range(r.randint(0, 14))) for _ in range(2000)]
    encode = packing.ChunkTokenizer(VOCABULARY, cache=50)
    assert encode(odd + some) == [encode._encode(x) for x in odd + some]
    encode = packing.ChunkTokenizer(VOCABULARY)
    assert encode(["one two, two\nthree"]) == [encode._encode("one two, two\nthree")]
    # Words are kept as they stand, without a new string for the space before each.
    assert set(encode.spaced) == {"two,", "two"} and set(encode.known) == {"one", "three", ",", "\n"}


def test_workers_forget_what_others_kept(frame):
    docs = frame([prose(i, 20) for i in range(8)]).coalesce(1).select("text")

    def keep(rows):
        common.kept("much", lambda: [0])
        return [(len(list(rows)),)]

    def look(rows):
        n = len(list(rows))
        return [(n, len(common._KEPT))]

    assert common.map_rows(docs, keep, "n int", keeps="much").first()[0] == 8
    assert common.map_rows(docs, look, "n int, kept int").first()[1] == 0
    assert packing.pack(frame(["a b c"]), VOCABULARY).count() == 1
    assert common.map_rows(docs, look, "n int, kept int").first()[1] == 0


def test_words_that_come_once_are_not_kept():
    encode = packing.ChunkTokenizer(VOCABULARY)
    text = " ".join(f"word{i}" for i in range(60_000))
    want = encode._encode(text)
    assert encode([text]) == [want]
    assert len(encode.spaced) + len(encode.known) < 30_000
    assert encode([text, text]) == [want, want]
    assert len(encode.spaced) + len(encode.known) > 59_000


def test_freed_stores_are_gone_at_once():
    import weakref

    class Store(dict):
        pass

    def make():
        store = Store()
        store["me"] = store
        return store

    gone, stays = weakref.ref(common.kept("gone", make)), weakref.ref(common.kept("stays", make))
    common.release("stays")
    assert gone() is None and stays() is not None
    common.release()
    assert stays() is None


def test_ids_leave_the_worker_only_if_asked_for(frame):
    docs = frame([prose(i, 900) for i in range(4)] + ["", None])
    whole = packing.pieces(docs, VOCABULARY, 256)
    light = packing.pieces(docs, VOCABULARY, 256, ids=False)
    assert light.columns == whole.columns[:-1]
    assert sorted(light.collect()) == sorted(whole.drop("ids").collect())


def test_marks_tell_rows_apart(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).withColumn("h", F.xxhash64("id"))
    held = common.marks(rows.where("id % 10 = 0").select(F.col("h").alias("spot")))
    there = {x["id"] for x in common.by_marks(rows, F.col("h"), held).collect()}
    others = {x["id"] for x in common.by_marks(rows, F.col("h"), held, there=False).collect()}
    assert there | others == set(range(5000)) and not there & others
    assert set(range(0, 5000, 10)) <= there and len(there) < 520


def test_texts_of_others_are_not_moved(spark, frame, monkeypatch):
    """Without broadcasts by size, unrelated texts still meet the bitmap where they are."""
    monkeypatch.setattr(jaccard, "LIGHTEST", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = frame([prose(i // 2 if i < 4 else i, 60) for i in range(30)])
        c = jaccard.classes(docs, "doc_id", "text", 5, jaccard.LEAST)
        wanted = c.nodes.limit(2).select("node")
        found = c.texts(wanted)
        assert 2 <= found.count() <= 3
        assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
        kept = jaccard.drop_similar(docs)
        assert "BroadcastHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(x["doc_id"] for x in kept.collect()) == [0, 2, *range(4, 30)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lone_cells_are_left_where_they_are(frame, monkeypatch):
    counts = {}

    def counted(rows, name):
        made = common.stored(rows, name)
        counts[name] = made.count()
        return made

    monkeypatch.setattr(substrings, "stored", counted)
    texts = [prose(1, 300), prose(1, 300), *(prose(i, 300) for i in range(2, 40))]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.kept_words(frame(texts)).collect()}
    assert got == {i: 300 if i == 1 else 0 for i in range(40)}
    own = len(substrings.cells(texts[0].encode().split()))
    assert counts["cells"] == own and counts["seeds"] == 40
