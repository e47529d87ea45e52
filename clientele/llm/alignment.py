"""Alignment of the tokens of two vocabularies over the same texts.

Byte offsets at which tokens of both vocabularies end cut a text into groups. A fragment
is what is known of a byte range of a text: an open prefix, closed groups, an open suffix.
Fragments compose: the suffix of one and the prefix of the next are the text between two
places where no token of either vocabulary crosses, and give closed groups of their own.
Composition is associative, so a text may be cut anywhere and put together in any order:

* words are closed fragments; each distinct word of a batch is encoded and aligned once,
  and a text's fragment is composed of its words' fragments;
* longer texts than ``CHUNK_BYTES`` are cut into byte ranges that go to different tasks,
  whose fragments are composed eight at a time, level by level, until one is left. Group
  strings do not move up the tree; they are hashed as a stream, range by range.

Pairs of ids that are linked anywhere are counted over all documents by sums of the counts
of each batch. The two vocabularies bound their number.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clientele.llm.arrow import slices
from clientele.llm.scratch import stored
from clientele.llm.tokens import Encoder, byte_letters

A_NAME, B_NAME = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES = 65_536
FAN = 8
#: Pairs whose counts are broadcast, some 100 MB; more are joined by a shuffle.
BROADCAST_PAIRS = 4_000_000
#: Words in each of the two generations that a worker keeps, and the longest kept.
KEPT_WORDS, KEPT_CHARS = 100_000, 48

_WHITE = r"\t-\r\x1c-\x20\x85\xa0  -     　"
#: A space that begins a word: white space on neither side. No token of a byte-level or a
#: piece vocabulary holds it behind another character.
_SPACE = re.compile(f"(?<=[^{_WHITE}]) (?=[^{_WHITE}])")
_ODD = r"[\t-\r\x1c-\x20\x{85}\pZ] | [\t-\r\x1c-\x20\x{85}\pZ]|^ | $"
#: The same in bytes, for fewer characters on the two sides.
_CUT = re.compile(
    rb"(?:(?<=[!-~])|(?<=[\xc3-\xdf][\x80-\xbf])|(?<=[\xe0\xe4-\xef][\x80-\xbf]{2})|(?<=[\xf0-\xf4][\x80-\xbf]{3}))"
    rb"(?= [!-~\xc3-\xe0\xe4-\xf4])"
)


def _file(name: str) -> str:
    return name if "/" in name else public_tokenizers.path(name)


@dataclass
class Fragment:
    """A byte range of a text. Without a ``cut`` all of it is ``prefix``."""

    idx: int
    cut: bool = False
    prefix: bytes = b""
    suffix: bytes = b""
    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    #: Groups that were closed by composing, as (range that they lie before, their string).
    seams: tuple[tuple[int, str], ...] = ()


def ends_of(data: bytes) -> tuple[bytes, bytes, bytes] | None:
    """Open prefix, closed part and open suffix of a byte range; none without a cut."""
    cuts = [m.start() for m in _CUT.finditer(data)]
    return (data[: cuts[0]], data[cuts[0] : cuts[-1]], data[cuts[-1] :]) if cuts else None


class Aligner:
    """Fragments of words and texts for one pair of vocabularies."""

    def __init__(self, a_name: str, b_name: str):
        self._a = Encoder(_file(a_name), words=False)
        vocabulary = Tokenizer.from_file(_file(a_name)).get_vocab()
        letters = byte_letters()
        self._a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self._a_bytes[i] = bytes(letters[x] for x in token)
        self._b = sentencepiece.SentencePieceProcessor(model_file=_file(b_name))
        self._b_bytes = [self._piece(i) for i in range(self._b.vocab_size())]
        self.n_b = len(self._b_bytes)
        self._a_sizes, self._b_sizes = (
            np.fromiter(map(len, x), np.int64, len(x)) for x in (self._a_bytes, self._b_bytes)
        )
        self._new: dict[str, tuple] = {}
        self._old: dict[str, tuple] = {}

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        if self._b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        special = self._b.is_control(i) or self._b.is_unknown(i)
        return b"" if special else piece.replace("▁", " ").encode()

    def _align(self, words: list[str]) -> list[tuple]:
        """For each word with a space before it: whether its tokens give its bytes, counts
        of A ids, B ids and groups, its links, and its groups as a string."""
        a_ids = [np.frombuffer(x, "<u4").tolist() for x in self._a._encode_new([" " + w for w in words])]
        b_ids = self._b.encode(words, num_threads=1)
        ok = []
        for w, a, b in zip(words, a_ids, b_ids):
            data = b" " + w.encode()
            ok.append(
                b"".join([self._a_bytes[i] for i in a]) == data
                and b"".join([self._b_bytes[i] for i in b]) == data
            )
        a_all = np.array([i for x, good in zip(a_ids, ok) if good for i in x], np.int64)
        b_all = np.array([i for x, good in zip(b_ids, ok) if good for i in x], np.int64)
        a_ends, b_ends = np.cumsum(self._a_sizes[a_all]), np.cumsum(self._b_sizes[b_all])
        # Between two ends of any kind lies one link.
        ends = np.union1d(a_ends, b_ends)
        links = a_all[np.searchsorted(a_ends, ends)] * self.n_b + b_all[np.searchsorted(b_ends, ends)]
        a_common = np.isin(a_ends, b_ends, assume_unique=True).tolist()
        b_common = np.isin(b_ends, a_ends, assume_unique=True).tolist()
        out, ia, ib, at = [], 0, 0, 0
        for a, b, good in zip(a_ids, b_ids, ok):
            if not good:
                out.append((False, 0, 0, 0, b"", b""))
                continue
            groups_a, groups_b = self._groups(a, a_common, ia), self._groups(b, b_common, ib)
            ia, ib, n = ia + len(a), ib + len(b), len(a) + len(b) - len(groups_a)
            text = ";".join(map("|".join, zip(groups_a, groups_b))).encode()
            out.append((True, len(a), len(b), len(groups_a), links[at : at + n].tobytes(), text))
            at += n
        return out

    @staticmethod
    def _groups(ids: list[int], common: list[bool], at: int) -> list[str]:
        found, own = [], []
        for k, i in enumerate(ids):
            own.append(str(i))
            if common[at + k]:
                found.append(",".join(own))
                own = []
        return found

    def _words(self, words: list[str]) -> list[tuple]:
        if len(self._new) > KEPT_WORDS:
            self._old, self._new = self._new, {}
        new, old = self._new, self._old
        found = [new.get(w) or old.get(w) for w in words]
        lacking = [i for i, x in enumerate(found) if x is None]
        for begin in range(0, len(lacking), 20_000):
            some = lacking[begin : begin + 20_000]
            for i, x in zip(some, self._align([words[i] for i in some])):
                found[i] = x
        for w, x in zip(words, found):
            if len(w) <= KEPT_CHARS:
                new[w] = x
        return found

    def texts(self, texts: pa.Array) -> dict[str, list | np.ndarray]:
        """Columns over the texts, each with a space before it: ``ok, n_a, n_b, n_groups``,
        the distinct links ``pairs`` of all, how many ``times`` each, where each text's
        ``begin``, and the strings of groups. A text that is not ``ok`` has no tokens."""
        texts = texts.cast(pa.large_string())
        if pc.any(pc.match_substring_regex(texts, _ODD)).as_py():
            lists = pa.array([_SPACE.split(x) for x in texts.to_pylist()], pa.large_list(pa.large_string()))
        else:
            lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        ok, n_a, n_b, n_groups, links, strings = zip(*self._words(coded.dictionary.to_pylist()))
        counts = []
        for column in (np.array(ok, np.int64), n_a, n_b, n_groups):
            sums = np.concatenate([[0], np.cumsum(np.asarray(column, np.int64)[codes])])
            counts.append(sums[at[1:]] - sums[at[:-1]])
        good = counts[0] == at[1:] - at[:-1]
        rows = np.repeat(np.arange(len(texts)), at[1:] - at[:-1])
        kept = good[rows]
        codes, rows = codes[kept], rows[kept]
        sizes = np.fromiter(map(len, links), np.int64, len(links)) // 8
        flat, starts = np.frombuffer(b"".join(links), np.int64), np.cumsum(sizes) - sizes
        took = sizes[codes]
        ends = np.cumsum(took)
        where = np.repeat(starts[codes] - (ends - took), took) + np.arange(ends[-1] if len(ends) else 0)
        # One number for the text and the link.
        shift = len(self._a_bytes) * self.n_b
        keys, times = np.unique(np.repeat(rows, took) * shift + flat[where], return_counts=True)
        begin = np.searchsorted(keys, np.arange(len(texts) + 1) * shift)
        every = np.array([*strings, None], dtype=object)[codes].tolist()
        cuts = np.searchsorted(rows, np.arange(len(texts) + 1)).tolist()
        return {
            "ok": good,
            **{k: np.where(good, x, 0) for k, x in zip(("n_a", "n_b", "n_groups"), counts[1:])},
            "pairs": keys % shift,
            "times": times,
            "begin": begin,
            "strings": [b";".join(every[a:b]) for a, b in zip(cuts, cuts[1:])],
        }

    def closed(self, idx: int, data: bytes) -> tuple[Fragment, str]:
        """A closed fragment, and the string of its groups."""
        if not data:
            return Fragment(idx, cut=True), ""
        found = self.texts(pa.array([data[1:].decode()]))
        return Fragment(
            idx, True, b"", b"", bool(found["ok"][0]), *(int(found[k][0]) for k in ("n_a", "n_b", "n_groups")),
            found["pairs"], found["times"],
        ), found["strings"][0].decode()

    def range_fragment(self, idx: int, data: bytes, first: bool, last: bool) -> tuple[Fragment, str]:
        """The fragment of a byte range, and the string of its closed groups. The first range
        of a text, with the space before it, and the last are closed on one side."""
        found = ends_of(data)
        if first and last:
            parts = b"", data, b""
        elif first:
            parts = (b"", found[0] + found[1], found[2]) if found else (b"", b"", data)
        elif last:
            parts = (found[0], found[1] + found[2], b"") if found else (data, b"", b"")
        elif found:
            parts = found
        else:
            return Fragment(idx, prefix=data), ""
        inner, string = self.closed(idx, parts[1])
        return replace(inner, prefix=parts[0], suffix=parts[2]), string

    def compose(self, f: Fragment, g: Fragment) -> Fragment:
        """The fragment of two ranges, one behind the other."""
        between = (f.suffix if f.cut else f.prefix) + g.prefix
        found = (b"", between, b"") if f.cut and g.cut else ends_of(between)
        if found is None:
            if f.cut:
                return replace(f, suffix=between)
            return replace(g, idx=f.idx, prefix=between)
        if f.cut:
            found = b"", found[0] + found[1], found[2]
        if g.cut:
            found = found[0], found[1] + found[2], b""
        inner, string = self.closed(g.idx, found[1])
        pairs, back = np.unique(np.concatenate([f.pairs, inner.pairs, g.pairs]), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, back, np.concatenate([f.times, inner.times, g.times]))
        return Fragment(
            f.idx, True, f.prefix if f.cut else found[0], g.suffix if g.cut else found[2],
            f.ok and inner.ok and g.ok, f.n_a + inner.n_a + g.n_a, f.n_b + inner.n_b + g.n_b,
            f.n_groups + inner.n_groups + g.n_groups, pairs, times,
            f.seams + (((g.idx, string),) if string else ()) + g.seams,
        )


@lru_cache(maxsize=2)
def aligner(a_name: str, b_name: str) -> Aligner:
    """One per worker process; names are files of the public tokenizers, or paths."""
    return Aligner(a_name, b_name)


# --- texts of one range ------------------------------------------------------

_ROW = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string,"
    " pairs array<bigint>, times array<bigint>"
)
_ROW_NAMES = [x.split()[0] for x in _ROW.split(", ")]


def _lists(begin: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(values, pa.int64()))


def _short(docs: DataFrame, a_name: str, b_name: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, n = aligner(a_name, b_name), TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            texts = batch.column(1)
            # An empty text has no tokens, although the space before it has.
            there = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            found = tool.texts(texts)
            good = found["ok"] & there
            keep = np.repeat(good, np.diff(found["begin"]))
            begin = np.concatenate([[0], np.cumsum(np.where(good, np.diff(found["begin"]), 0))])
            sums = [
                hashlib.sha256(x).hexdigest() if ok else "" for x, ok in zip(found["strings"], good.tolist())
            ]
            counts = [pa.array(np.where(good, found[k], 0), pa.int64()) for k in ("n_a", "n_b", "n_groups")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(n, n + len(batch)), pa.int64()), batch.column(0), *counts,
                    pa.array(sums, pa.string()), _lists(begin, found["pairs"][keep]), _lists(begin, found["times"][keep]),
                ],
                _ROW_NAMES,
            )
            n += len(batch)

    return docs.mapInArrow(rows, _ROW)


# --- texts of several ranges -------------------------------------------------

_FRAGMENT = (
    "cut boolean, prefix binary, suffix binary, ok boolean, n_a bigint, n_b bigint, n_groups bigint,"
    " pairs array<bigint>, times array<bigint>, seams array<struct<idx:int,text:string>>"
)
_SEAM = pa.list_(pa.struct([("idx", pa.int32()), ("text", pa.string())]))
_FRAGMENT_TYPES = [
    pa.bool_(), pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(),
    pa.list_(pa.int64()), pa.list_(pa.int64()), _SEAM,
]
_FRAGMENT_NAMES = ["cut", "prefix", "suffix", "ok", "n_a", "n_b", "n_groups", "pairs", "times", "seams"]


def _values(f: Fragment) -> list:
    seams = [{"idx": i, "text": x} for i, x in f.seams]
    return [f.cut, f.prefix, f.suffix, f.ok, f.n_a, f.n_b, f.n_groups, f.pairs, f.times, seams]


def _ranges(docs: DataFrame, size: int) -> DataFrame:
    """Byte ranges of long texts, dealt out by text and range; copies of a row are counted."""
    own = docs.withColumns(
        {
            "key": F.concat(
                F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.sha2("text", 256)
            ),
            "last": F.expr(f"cast((octet_length(text) - 1) div {size} as int)"),
        }
    )
    parts = own.select("key", "doc_id", "last", "text", F.explode(F.expr("sequence(0, last)")).alias("idx"))
    data = F.expr(f"substring(cast(text as binary), idx * {size} + 1, {size})")
    return (
        parts.select("key", "doc_id", "last", "idx", data.alias("data"))
        .groupBy("key", "doc_id", "last", "idx")
        .agg(F.first("data").alias("data"), F.count("*").alias("copies"))
    )


def _long(docs: DataFrame, a_name: str, b_name: str, size: int) -> DataFrame | None:
    head = ["key", "doc_id", "copies", "idx"]
    head_schema = "key string, doc_id bigint, copies bigint, idx int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a_name, b_name)
        for batch in slices(batches):
            out = []
            for idx, last, data in zip(*(batch.column(k).to_pylist() for k in ("idx", "last", "data"))):
                data = data if idx else b" " + data
                f, string = tool.range_fragment(idx, data, idx == 0, idx == last)
                out.append([*_values(f), string])
            yield _batch([batch.column(k) for k in head], out, [*_FRAGMENT_TYPES, pa.string()], [*head, *_FRAGMENT_NAMES, "string"])

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a_name, b_name)
        for batch in slices(batches):
            out = []
            for parts in batch.column(4).to_pylist():
                whole = _fragment(parts[0])
                for x in parts[1:]:
                    whole = tool.compose(whole, _fragment(x))
                out.append(_values(whole))
            yield _batch(batch.columns[:4], out, _FRAGMENT_TYPES, [*head, *_FRAGMENT_NAMES])

    parts = _ranges(docs, size).select(*head, "last", "data")
    leaves = stored(parts.mapInArrow(cut, f"{head_schema}, {_FRAGMENT}, string string"), "fragments")
    most = leaves.agg(F.max("idx")).first()[0]
    if most is None:
        return None
    level, width = leaves.select(*head, *_FRAGMENT_NAMES), 1
    while width <= most:
        width *= FAN
        group = F.expr(f"cast(idx div {width} as int) * {width}").alias("idx")
        some = level.groupBy("key", "doc_id", "copies", group).agg(
            F.sort_array(F.collect_list(F.struct("idx", *_FRAGMENT_NAMES))).alias("parts")
        )
        level = stored(some.mapInArrow(compose, f"{head_schema}, {_FRAGMENT}"), "composed")
    strings = leaves.select("key", "idx", F.lit(1).alias("side"), F.col("string").alias("text"))
    seams = level.select("key", F.inline("seams")).select("key", "idx", F.lit(0).alias("side"), "text")
    order = ["key", "idx", "side"]
    sums = (
        strings.union(seams).where("text <> ''").repartition("key").sortWithinPartitions(*order)
        .mapInArrow(_stream_sums, "key string, groups_sha256 string")
    )
    count = {k: F.when(F.col("ok"), F.col(k)).otherwise(0).alias(k) for k in ("n_a", "n_b", "n_groups")}
    lists = [
        F.when(F.col("ok"), F.col(k)).otherwise(F.array().cast("array<bigint>")).alias(k) for k in ("pairs", "times")
    ]
    whole = level.join(sums, "key", "left").withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
    return whole.select(
        (-1 - F.monotonically_increasing_id()).alias("row"), "doc_id", *count.values(),
        F.when(F.col("ok"), F.col("groups_sha256")).otherwise("").alias("groups_sha256"), *lists,
    )


def _fragment(x: dict) -> Fragment:
    seams = tuple((s["idx"], s["text"]) for s in x["seams"])
    pairs, times = np.array(x["pairs"], np.int64), np.array(x["times"], np.int64)
    return Fragment(**{**x, "seams": seams, "pairs": pairs, "times": times})


def _batch(head: list[pa.Array], out: list[list], types: list, names: list[str]) -> pa.RecordBatch:
    columns = zip(*out) if out else [()] * len(types)
    return pa.RecordBatch.from_arrays([*head, *(pa.array(c, t) for c, t in zip(columns, types))], names)


def _stream_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sha256 of each key's texts, joined by semicolons; no key is held whole."""
    key, state = None, None
    for batch in batches:
        done = []
        for own, text in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if own != key:
                if state:
                    done.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b";" + text.encode())
        yield _sum_batch(done)
    if state:
        yield _sum_batch([(key, state.hexdigest())])


def _sum_batch(found: list[tuple[str, str]]) -> pa.RecordBatch:
    columns = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["key", "groups_sha256"])


# --- counts over all documents -----------------------------------------------


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    a_name: str = A_NAME,
    b_name: str = B_NAME,
    chunk_bytes: int = CHUNK_BYTES,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Per row ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A text is encoded with a space before it, by the byte-level vocabulary A and the piece
    vocabulary B, special tokens as plain text. ``n_links`` is the number of A and B tokens
    that overlap, ``count_sum`` the sum over them of the rows that hold the pair of ids linked,
    ``n_best`` how many of them have the highest such count of their A id. ``groups_sha256``
    is over the groups as ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts and those that a vocabulary does not give back byte for byte, as
    with U+2581, have no tokens: zeros and an empty string. Each row counts as a document,
    also one that repeats another; null ids stay null. Other columns are not looked at.
    """
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    size = F.octet_length("text")
    rows = stored(_short(own.where(size <= chunk_bytes), a_name, b_name), "aligned")
    long = _long(own.where(size > chunk_bytes), a_name, b_name, chunk_bytes)
    if long is not None:
        rows = rows.union(stored(long, "aligned_long"))
    n_b = sentencepiece.SentencePieceProcessor(model_file=_file(b_name)).vocab_size()
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    own_a = Window.partitionBy(F.expr(f"pair div {n_b}"))
    counts = stored(
        counts.select("pair", "n", (F.col("n") == F.max("n").over(own_a)).alias("best")), "pair_counts"
    )
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    links = rows.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    zero = [F.coalesce(k, F.lit(0)).alias(k) for k in ("n_links", "n_best", "count_sum")]
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", *zero, "groups_sha256"
    )
