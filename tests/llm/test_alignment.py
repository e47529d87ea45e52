import hashlib
import random
from collections import Counter
from functools import reduce

import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clientele.llm.alignment import A_NAME, B_NAME, align, aligner, byte_letters
from tests.llm.data import awkward, nothing

A = Tokenizer.from_file(public_tokenizers.path(A_NAME))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B_NAME))
LETTERS = byte_letters()


def tokens(text):
    """(id, first byte, end) of both vocabularies; none if bytes differ."""
    if not text:
        return None
    data, out = (" " + text).encode(), []
    a = [(i, bytes(LETTERS[x] for x in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()) for i in B.encode(text) for p in [B.id_to_piece(i)]]
    for found in (a, b):
        if b"".join(x for _, x in found) != data:
            return None
        at, own = 0, []
        for i, x in found:
            own.append((i, at, at + len(x)))
            at += len(x)
        out.append(own)
    return out


def plain(rows):
    found = [tokens(text) for _, text in rows]
    links = [[(a[0], b[0]) for a in f[0] for b in f[1] if a[1] < b[2] and b[1] < a[2]] if f else [] for f in found]
    counts = Counter(pair for own in links for pair in set(own))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (i, _), f, own in zip(rows, found, links):
        if not f:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        ends = sorted({a[2] for a in f[0]} & {b[2] for b in f[1]})
        groups = []
        for start, end in zip([0, *ends], ends):
            groups.append("|".join(",".join(str(x[0]) for x in side if start < x[2] <= end) for side in f))
        out.append((i, len(f[0]), len(f[1]), len(groups), len(own), sum(counts[p] == best[p[0]] for p in own),
            sum(counts[p] for p in own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


TEXTS = [
    "Plain words, and more words.", "  leading and  double   spaces ", "line\nline \n\n\tline", "naïve Ünïcode 漢字かな 🙂🙂 é",
    "a▁piece mark", "nul \x00 and \x85 white\xa0space", "<|endoftext|> and </s> <s><unk>", " ", "\n", "x", "aaaa" * 40,
    "мир труд май " * 9, "漢字" * 50, "don't we'll I'm 12345 67 !!??", "word " * 60 + "end", "　wide 　 spaces x",
]


def check(spark, docs, **options):
    result = align(docs, **options)
    assert result.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(str, map(tuple, result.collect()))) == sorted(map(str, plain(rows)))


def test_texts(spark):
    rows = [*enumerate(TEXTS), (7, TEXTS[0]), (None, TEXTS[1]), (None, None), (50, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(spark, docs)
    # Texts of several ranges, some with copies; and counts that are not broadcast.
    check(spark, docs.union(docs), chunk_bytes=7, broadcast_pairs=0)


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    short = docs.where("doc_id is null or doc_id <> 7")
    check(spark, short)
    # The long text, cut or not.
    whole, cut = (
        sorted(map(str, align(docs, chunk_bytes=n).collect())) for n in (10_000_000, 1000)
    )
    assert whole == cut and len(whole) == docs.count()
    assert align(nothing(spark)).collect() == []


def _same(f, g):
    return (f.cut, f.prefix, f.suffix, f.ok, f.n_a, f.n_b, f.n_groups, f.pairs.tolist(), f.times.tolist()) == (
        g.cut, g.prefix, g.suffix, g.ok, g.n_a, g.n_b, g.n_groups, g.pairs.tolist(), g.times.tolist())


@settings(deadline=None, max_examples=150)
@given(st.text(st.sampled_from("ab, \n▁é漢'1"), max_size=40), st.lists(st.integers(0, 120), max_size=6), st.randoms())
def test_composition_is_associative(text, cuts, rng):
    tool = aligner(A_NAME, B_NAME)
    data = (" " + text).encode()
    cuts = sorted({0, len(data), *(c for c in cuts if c < len(data))})
    parts, strings = [], []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        f, string = tool.range_fragment(k, data[a:b], a == 0, b == len(data))
        parts.append(f)
        strings.append((k, 1, string))
    whole = reduce(tool.compose, parts)
    while len(parts) > 1:  # in any other order
        i = rng.randrange(len(parts) - 1)
        parts[i : i + 2] = [tool.compose(parts[i], parts[i + 1])]
    assert _same(whole, parts[0])
    expected, string = tool.range_fragment(0, data, True, True)
    assert whole.ok == expected.ok
    if whole.ok:
        assert _same(whole, expected)
        seams = [(k, 0, x) for k, x in parts[0].seams]
        assert ";".join(x for _, _, x in sorted(strings + seams) if x) == string


def test_words_are_cut_where_no_token_crosses():
    rng = random.Random(3)
    alphabet = ["a", "the", " ", " ", "\n", ".", "'s", "12", "é", "漢", "　", "\t", "🙂"]
    tool = aligner(A_NAME, B_NAME)
    texts = ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(300)]
    found = tool.texts(pa.array(texts))
    for i, text in enumerate(texts):
        f = tokens(text)
        assert bool(found["ok"][i]) == (f is not None)
        if f:
            assert (found["n_a"][i], found["n_b"][i]) == (len(f[0]), len(f[1]))
