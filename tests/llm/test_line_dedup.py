import hashlib

from clientele.llm.line_dedup import drop_repeated_lines, line_report
from tests.helpers import settings
from tests.llm.data import awkward, lower, nothing

WHITE = " \t\n\x0b\x0c\r"


def plain(rows):
    """Kept lines of each (id, text), with ids that are missing in one document at the end."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = lower(line.strip(WHITE))
            if len(key) >= 10 and (key not in first or order(i) < order(first[key])):
                first[key] = i
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        out.append([x for x in lines if first.get(lower(x.strip(WHITE)), i) == i])
    return out


def check(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = sorted(
        str((i, (t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
        for (i, t), kept in zip(rows, plain(rows))
    )
    assert sorted(str(tuple(r)) for r in line_report(docs).collect()) == expected


def test_awkward_documents(spark):
    check(spark, awkward(spark))


def test_keys_cut_between_parts(spark):
    # Far more parts than keys: every key begins in one part and goes on in others.
    rows = [(i, f"the very same line in all\n{'x' * 12}{i % 3}\nown line number {i}") for i in range(400)]
    with settings(spark, spark_sql_shuffle_partitions="40", spark_sql_adaptive_enabled="false"):
        check(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_texts_and_other_columns(spark):
    docs = awkward(spark)
    kept = drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = sorted(str((i, "\n".join(k))) for (i, t), k in zip(rows, plain(rows)))
    assert sorted(str((r["doc_id"], r["text"] or "")) for r in kept.collect()) == expected


def test_empty_table(spark):
    assert line_report(nothing(spark)).collect() == []
    assert drop_repeated_lines(nothing(spark)).collect() == []
