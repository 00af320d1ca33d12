import hashlib

from cases import alnum, documents, sentence, texts
from pyspark.sql import functions as F

from millrace.llm import decontaminate
from millrace.llm.decontaminate import scan


def items():
    passage = sentence(2, 60)
    return [(1, passage), (2, passage), (3, "One, TWO; three"), (4, None), (5, ""), (6, "..."), (None, sentence(1, 15)),
            (10, sentence(3, 12)), (7, "é ß ñ")]


def plain(rows, bench):
    windows = {}
    for i, t in bench:
        w = alnum(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[a : a + k]), set()).add(i)
    out = []
    for i, t in rows:
        w, hit, found = alnum(t), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    hit |= set(range(a, a + k))
                    found |= windows[tuple(w[a : a + k])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), names))
    return sorted(out, key=str)


def test_scan_equals_brute_force_in_any_number_of_shards(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    want = plain(texts(), items())
    for shard in (1_000_000, 20):
        got = scan(documents(spark), bench, shard=shard).select("doc_id", "n_words", "n_hit", "hit_items").collect()
        assert sorted([tuple(r) for r in got], key=str) == want


def test_clashing_columns_are_replaced_and_others_kept(spark):
    got = scan(documents(spark), spark.createDataFrame(items(), "item_id long, text string"))
    assert got.columns == ["doc_id", "text", "lang", "code", "rate", "n_words", "n_hit", "hit_items", "hit_mask"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert scan(documents(spark), none).agg(F.sum("n_hit")).first()[0] == 0
    assert scan(documents(spark, []), none).count() == 0


def test_removal(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    docs = documents(spark).withColumn("n_chars", F.length("text"))
    found = decontaminate.decontaminate(docs, bench)
    assert found.columns == docs.columns
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[1].n_words == 7
    passage = sentence(2, 60)
    assert passage not in rows[11].text and rows[11].text.startswith(sentence(4, 40)) and rows[11].n_chars == len(rows[11].text)
    assert 8 not in rows and 9 not in rows  # nothing but a benchmark item
    assert rows[16].text == sentence(8, 200) and rows[4].text is None and rows[5].text == ""


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
