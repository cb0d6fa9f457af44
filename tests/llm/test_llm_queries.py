"""The registered queries of the subpackage on the smallest tables, against SQL or for their shape."""

from __future__ import annotations

import importlib.util

import pytest

import corpus_pipeline
from checks.compare import differences, duck
from kpiloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = queries.queries(), queries.oracle_sql()
ROWS = {"op1": None, "op9": None, "op10": 50, "op12": 500 * 32}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(session, name):
    assert differences(session, duck(FOLDER), QUERIES[name], SQL[name], FOLDER) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(session, name):
    frame = QUERIES[name](session, FOLDER)
    rows = frame.collect()
    expected = ROWS.get(name.split("_")[0], 200)
    assert expected is None or len(rows) == expected
    assert name.startswith("op12") or {r.doc_id for r in rows} == set(range(200))


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    import __spark_entry__ as registered

    assert set(QUERIES) | {"pipeline"} <= set(registered.queries()) and importlib.util.find_spec("kpiloom.llm")


def test_held_out_rows_do_not_change_what_is_learnt(session, small, tmp_path):
    """Texts of held-out rows are replaced; scores of all others stay."""
    from pyspark.sql import functions as F

    folder = str(tmp_path)
    for name in ("documents", "labels"):
        small(name).write.parquet(f"{folder}/{name}.parquet")
    for name, parts, out in (("op3_log_bloom", 5, 1), ("op5_nb_ngrams", 3, 1), ("op6_cross_parsing", 4, 2)):
        changed = f"{folder}/{name}"
        held = F.expr(queries.remainder(parts, out))
        docs = small("documents").withColumn("text", F.when(held, F.lit("idiot idiot el la")).otherwise(F.col("text")))
        docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).write.parquet(f"{changed}/documents.parquet")
        labels = small("labels").withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
        labels.write.parquet(f"{changed}/labels.parquet")
        kept = [
            {r.doc_id: r for r in QUERIES[name](session, f).where("NOT held_out").drop("held_out").collect()}
            for f in (folder, changed)
        ]
        assert kept[0] == kept[1] and len(kept[0]) > 100


def test_pipeline_stages(session, small):
    """Each stage against a plain version over what the stage before it kept."""
    from collections import Counter, defaultdict

    from test_decontamination import plain as leaks
    from test_neardup import plain as near
    from test_packing import assert_gapless, whole
    from test_secret_scan import plain as secrets

    docs = small("documents")
    columns = docs.columns
    odd = [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (1002, "123 456", "en", "s", 7)]
    docs = docs.union(session.createDataFrame(odd, docs.schema))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "secrets", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(session, docs, FOLDER).cache()
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "packing" or docs.columns == columns
    before = {r.doc_id: r for r in small("documents").collect()}
    assert set(kept["language_id"]) == {i for i, r in before.items() if any(c.isalpha() for c in r.text)}
    rows = sorted((i, r.text) for i, r in kept["language_id"].items())
    assert set(kept["near_duplicates"]) == {k for k, _, _, stays in near(rows, 5) if stays}
    rows = [(i, r.text) for i, r in kept["near_duplicates"].items()]
    items = [(r.item_id, r.text) for r in small("benchmark").collect()]
    assert set(kept["decontamination"]) == set(dict(rows)) - {doc for doc, *_ in leaks(rows, items)}
    assert set(kept["secrets"]) == set(kept["decontamination"])
    for i, r in kept["secrets"].items():
        assert not secrets(r.text) and (r.text == before[i].text) == (not secrets(before[i].text))
        assert r.n_chars == (len(r.text) if secrets(before[i].text) else before[i].n_chars)
    pieces = defaultdict(int)
    rows = docs.collect()
    for r in rows:
        pieces[r.doc_id] += r.length
    assert pieces == Counter({i: len(whole(r.text)) + 1 for i, r in kept["secrets"].items()})
    assert_gapless(rows, 1024)


CLASHING = ["score", "lang_pred", "row", "blob", "findings", "text_hash", "key", "kept", "leak", "Score2"]


def test_stages_keep_columns_of_their_own_names(session, small):
    from pyspark.sql import functions as F

    docs = small("documents").where("doc_id < 40").select("*", *(F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in CLASHING))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(session, docs, FOLDER)
        assert left.columns == docs.columns, name
        rows = left.collect()
        assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in CLASHING), name
    assert corpus_pipeline.pack(session, docs, FOLDER).count() >= 40


def test_stages_of_no_documents(session, small):
    for name, stage in corpus_pipeline.STAGES:
        left = stage(session, small("documents").limit(0), FOLDER)
        assert left.collect() == [], name
        assert name == "packing" or left.columns == small("documents").columns


def test_registered_secrets_agree_with_a_plain_scan(session, small):
    import hashlib

    from test_secret_scan import plain

    texts = {r.doc_id: r.text for r in small("documents").collect()}
    kinds = ["assign", "access", "hex"]
    for r in QUERIES["op8_blob_ledger"](session, FOLDER).collect():
        base = sorted(
            ((s, kinds.index(k), f"{k}:{s}:{e}") for k, s, e in plain(texts[r.doc_id]) if k in kinds)
        )
        joined = ",".join(span for *_, span in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))


def test_one_row_of_each_class_stays_with_null_and_repeated_ids(session, small):
    one, two, three = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    rows = [(None, one), (None, one), (5, one), (None, two), (None, two), (None, two + " end"), (6, three), (6, one + " end"), (6, three)]
    docs = session.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], small("documents").schema)
    left = corpus_pipeline.drop_near_duplicates(session, docs, FOLDER).collect()
    assert docs.columns == list(left[0].asDict()) and len(left) == 3
    left = {r.text: r.doc_id for r in left}
    assert left.pop(one) == 5 and left.pop(three) == 6
    assert list(left.values()) == [None] and set(left) <= {two, two + " end"}


def test_contaminated_rows_of_null_and_repeated_ids_take_no_clean_ones_along(session, small):
    item = max((r.text for r in small("benchmark").collect() if r.text), key=len)
    rows = [(None, item), (None, "clean one"), (7, f"a {item} b"), (7, "clean two"), (7, None), (8, "clean two"), (None, None)]
    docs = session.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], small("documents").schema)
    left = corpus_pipeline.drop_contaminated(session, docs, FOLDER).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in left), key=order) == sorted((r for r in rows if item not in (r[1] or "")), key=order)


def test_pipeline_runs(session):
    assert corpus_pipeline.run(session, FOLDER).count() > 150 and corpus_pipeline.ORACLE_SQL is None
