import os
import random
import subprocess
import sys

from pyspark.sql import functions as F

from scorecast.llm import queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    import corpus_pipeline as p
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in p.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "decontamination", "bpe"]
    for name, stage in p.STAGES[1:]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.count()
        assert after <= before
        if name != "bpe":
            assert docs.columns == columns
        before = after
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_go_by_rows(spark, tmp_path):
    """Null and repeated ids, nulls and clashing names: what goes is the row, not the id."""
    import corpus_pipeline as p
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(n))
    item, near, toxic = text(40), text(300), " ".join(["you vile scum"] * 5)
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, hash int, maybe boolean, item_id long"
    rest = ("en", None, 3, 4, "k", 5, False, 6)
    own = [text(60) for _ in range(6)]
    rows = [(None, own[0]), (None, f"{own[1]} {item} {text(9)}"), (7, own[2]), (7, f"{text(20)} {item}"), (7, near), (8, near + " more"), (None, near + " tail"),
            (9, None), (None, ""), (10, own[3]), (10, own[4]), (11, own[5] + " x"), (11, own[5] + " x")]
    docs = spark.createDataFrame([(*r, *rest) for r in rows], schema).repartition(3)
    folder = str(tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    copies = p.drop_copies(spark, docs, folder)
    assert copies.columns == docs.columns
    assert rows_of(copies.select("doc_id", "text")) == sorted([r for i, r in enumerate(rows) if i not in (8, 12)], key=str)
    left = p.drop_near_copies(spark, docs, folder)
    assert left.columns == docs.columns and left.filter(F.col("text").startswith(near)).count() == 1
    # of two rows alike both are one set's; all others stay
    assert left.count() == len(rows) - 2
    clean = p.drop_leaks(spark, docs, folder)
    assert clean.columns == docs.columns
    assert rows_of(clean.select("doc_id", "text")) == sorted([r for r in rows if item not in (r[1] or "")], key=str)
    # toxicity: rows by their own text, whatever the id
    labels = [(100 + i, i % 2) for i in range(400)]
    known = [(100 + i, f"{text(30)} {toxic if i % 2 else ''} {text(10)}") for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    more = [(None, f"{text(9)} {toxic}"), (7, f"{toxic} {text(5)}"), (7, text(30)), (None, None), (None, text(12)), (12, "")]
    all_ = spark.createDataFrame([(*r, *rest) for r in known + more], schema).repartition(3)
    kept = p.drop_toxic(spark, all_, folder)
    assert kept.columns == docs.columns
    assert [r for r in rows_of(kept.select("doc_id", "text")) if r[0] is None or r[0] < 100] == sorted([r for r in more if "scum" not in (r[1] or "")], key=str)
    none = docs.limit(0)
    for name, stage in p.STAGES:
        out = stage(spark, none, folder)
        assert out.count() == 0 and (name == "bpe" or out.columns == docs.columns), name


def test_toxicity_stage_and_whole_run(spark):
    import corpus_pipeline as p
    out = p.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("toxic = 0")
    kept = out.select("doc_id").distinct()
    assert 0 < out.count() <= docs.count() and out.filter("size(ids) != n_tokens").count() == 0
    clean = labels.join(p.drop_toxic(spark, docs, "/root/testdata/sf0.001"), "doc_id", "left_semi").count()
    assert clean >= 0.9 * labels.count() and kept.count() > 0.5 * docs.count()


def test_one_query_for_each_operator():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, len(names) + 1))
    assert set(queries.oracle_sql()) <= set(names)


def test_entry_works_without_the_package(tmp_path):
    code = ("import sys; sys.modules['scorecast.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "q = e.queries(); assert 'pipeline' not in q and not [k for k in q if k.startswith('op')] and len(q) >= 36; e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, capture_output=True)
