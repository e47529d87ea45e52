import hashlib
import random
import zlib

from pyspark.sql import functions as F

from clientele.llm.merkle import folded, levels_of, manifest, reduced, siblings
from tests.llm.data import awkward, nothing

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def own_hash(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def above(nodes):
    return [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]


def way(nodes, at):
    """The root, and the siblings of one node, each with its side."""
    found = []
    while len(nodes) > 1:
        if at ^ 1 < len(nodes):
            found.append((nodes[at ^ 1], at & 1))
        else:
            found.append(None)
        nodes, at = above(nodes), at // 2
    return nodes[0], found


def changed(row):
    i, source, lang, n, text = row
    if i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0:
        return (i, source, lang, n + 1, text)
    return row


def plain(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, own_hash(r))
    leaves = {x: [own_hash(r) for r in sorted(by_lang[x], key=order)] for x in langs}
    subroots = [way(leaves[x], 0)[0] for x in langs]
    out = []
    for k, lang in enumerate(langs):
        root, upper = way(subroots, k)
        for at, row in enumerate(sorted(by_lang[lang], key=order)):
            path = way(leaves[lang], at)[1] + upper
            node = own_hash(changed(row))
            for step in path:
                node = sha(node) if step is None else sha(step[0] + node if step[1] else node + step[0])
            out.append((row[0], own_hash(row), subroots[k], root, sha("".join(s[0] for s in path if s)), node, node == root))
    return out


def check(spark, docs, **options):
    mark = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(mark, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    result = manifest(docs, seen={"n_chars": n_chars}, **options)
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    assert sorted(map(str, map(tuple, result.collect()))) == sorted(map(str, plain(rows)))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")


def test_ids_of_any_size_and_many_groups(spark):
    rng = random.Random(5)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(150)] + list(range(-70, 300)) + [2**63 - 1, -(2**63)]
    rows = [(i, f"s{i % 4}", rng.choice(["en", "é", "", None, "a", "Z"]), rng.choice([None, 7]), "té" * (i % 5)) for i in ids]
    assert len({changed(r) == r for r in check(spark, table(spark, rows))}) == 2
    check(spark, table(spark, rows), levels=2)  # several steps of slot arrays
    check(spark, table(spark, [(i, None, f"l{i}", 1, "x") for i in range(40)]), levels=1)


def test_rows_that_share_an_id(spark):
    rows = [(3, "s", "en", k % 50, f"text {k % 400}") for k in range(900)]
    rows += [(None, "s", "en", 1, f"t{k % 20}") for k in range(60)] + [(i, "s", "en", 1, "x") for i in range(6)]
    check(spark, table(spark, rows), levels=3)


def test_awkward_and_empty_tables(spark):
    check(spark, awkward(spark))
    check(spark, nothing(spark))
    check(spark, table(spark, [(1, None, None, None, None)]))


def test_paths_lead_to_the_root():
    for n in range(1, 40):
        nodes = [sha(str(i)) for i in range(n)]
        rows = reduced(nodes, levels_of(n, 10))
        assert len(rows[-1]) == 1
        for i in range(n):
            assert folded(nodes[i], siblings(rows, i)) == rows[-1][0] == way(nodes, i)[0]
            assert folded(sha("other"), siblings(rows, i)) != rows[-1][0]
