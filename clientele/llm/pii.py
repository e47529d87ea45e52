"""Personal data in texts: fixed patterns, and a character tagger for other ways to write it.

The tagger is a bidirectional LSTM with CRF transitions (``bilstm_crf``), trained on the
driver from labelled spans: those that the patterns find in a bounded sample of documents,
and the same kinds of data written in other ways and put into the sample's text. It reads a
whole text in overlapping windows. Each place takes its tag from the window where it is
farthest from an end, the tags of all windows are joined into spans, and spans are
accepted if they are such data by their digits and do not touch what the patterns found.
Windows without a digit or an at sign are left out: no accepted span can lie in them. Where
a span reaches the end of the windows that were read, the next ones are read, too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import slices
from clientele.llm.bilstm_crf import Tagger

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_WORDS = _LOCAL - frozenset(".%+-")
_NO_DIGIT = re.compile(r"[^0-9]+")
_TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)
#: Data of the same kinds as the patterns do not see it.
_AT, _DOT = r"\s?(?:@|[\[(]at[\])])\s?", r"\s?(?:\.|[\[(]dot[\])])\s?"
_OTHER_EMAIL = re.compile(rf"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
_OTHER_IP = re.compile(r"[0-9]{1,3}(?:\s?[.,:\[\]()]{1,3}\s?[0-9]{1,3}){3}")

WINDOW, STRIDE = 64, 32
_EDGE = (WINDOW - STRIDE) // 2
_SYMBOLS = "0123456789@.+-() \n,:/[]_%'\"|"


@dataclass(frozen=True)
class Training:
    """The bounds of what the tagger is trained on, and its size: so many documents, of which
    windows come from the first ``characters``."""

    documents: int = 400
    characters: int = 20_000
    windows: int = 3000
    rounds: int = 8
    hidden: int = 20
    seed: int = 7


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _is_card(text: str) -> bool:
    digits = _NO_DIGIT.sub("", text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the patterns as (kind, start, end), by kind, then start."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        # All that an address can have before this sign, after the last address.
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        found = EMAIL.match(text, begin) if begin < at else None
        if found:
            last = found.end()
            out.append(("email", begin, last))
        at = text.find("@", max(at + 1, last))
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and _is_card(m[0]):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# --- the tagger --------------------------------------------------------------


def _symbol_table() -> np.ndarray:
    table = np.full(0x3000, 2, np.uint8)
    for code in range(len(table)):
        char = chr(code)
        if char.isalpha():
            table[code] = 3 if char.islower() else 4
    for i, char in enumerate("acdeimotAT"):
        table[ord(char)] = 5 + i
    for i, char in enumerate(_SYMBOLS):
        table[ord(char)] = 15 + i
    return table


_TABLE = _symbol_table()
_PAD, N_SYMBOLS = 1, 15 + len(_SYMBOLS)


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _TABLE[np.minimum(codes, len(_TABLE) - 1)]


def _tags(n: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    """0 outside; 1 and 2 where an email begins and goes on, 3 and 4 for ip, and so on."""
    tags = np.zeros(n, np.int8)
    for kind, start, end in spans:
        tags[start:end] = 2 + 2 * KINDS.index(kind)
        tags[start] -= 1
    return tags


def _disguised(kind: str, rng: np.random.Generator) -> str:
    """Invented data of a kind in a form that the patterns do not see."""

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word() -> str:
        return "".join(rng.choice(list("aeionrstlm"), rng.integers(3, 9)))

    if kind == "email":
        at = str(rng.choice([" [at] ", " (at) ", "[at]", " @ ", "(AT)"]))
        dot = str(rng.choice([" [dot] ", ".", "[dot]", " (dot) ", "."]))
        return f"{word()}{rng.choice(['', '.', '_'])}{digits(2)}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'example' + dot + 'com'])}"
    if kind == "ip":
        sep = str(rng.choice(["[.]", " . ", "(.)", ",", ":"]))
        return sep.join(str(x) for x in rng.integers(0, 256, 4))
    if kind == "card":
        number = digits(15)
        number += next(str(d) for d in range(10) if luhn(number + str(d)))
        return str(rng.choice([".", "/", "  ", " - ", "_"])).join(number[i : i + 4] for i in range(0, 16, 4))
    a, b, c = digits(3), digits(3), digits(4)
    return str(rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{digits(2)} {a} {b} {c}", f"{a}.{b}.{c}", f"+ {digits(2)} {a} {b} {c}"]))


def labelled_windows(texts: list[str], training: Training, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the texts with the tags of the patterns' spans; in half of them data is
    put in that is written in another way. Numbers that are no such data go in, too."""
    rng = np.random.default_rng(seed)
    texts = [t for t in texts if t] or ["Text."]
    xs, ys = [], []
    known = {t: base_spans(t) for t in texts}
    spots = [(t, s[1]) for t, found in known.items() for s in found]
    while len(xs) < training.windows:
        turn = len(xs) % 6
        if turn == 0 and spots:
            text, at = spots[rng.integers(len(spots))]
            at -= int(rng.integers(0, WINDOW - 8))
        else:
            text = texts[rng.integers(len(texts))]
            at = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
        at = max(0, at)
        piece = text[at : at + WINDOW]
        spans = [(k, s - at, e - at) for k, s, e in known[text] if s >= at and e <= at + WINDOW]
        if turn >= 2:
            kind = KINDS[turn - 2]
            put = _disguised(kind, rng)
            cut = int(rng.integers(0, max(1, len(piece))))
            while cut and piece[cut - 1].strip():
                cut -= 1
            piece, spans = piece[:cut] + put + " " + piece[cut:], [(kind, cut, cut + len(put))]
        elif turn == 1:
            n = int(rng.integers(1, 14))
            put = "".join(map(str, rng.integers(0, 10, n)))
            if rng.random() < 0.3:
                put = f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02} {rng.integers(0, 24):02}:{rng.integers(0, 60):02}"
            elif rng.random() < 0.3:
                put = "".join(rng.choice(list("0123456789abcdef"), 40))
            cut = int(rng.integers(0, max(1, len(piece))))
            while cut and piece[cut - 1].strip():
                cut -= 1
            piece, spans = piece[:cut] + put + " " + piece[cut:], []
        x, y = np.full(WINDOW, _PAD, np.uint8), np.zeros(WINDOW, np.int8)
        n = min(WINDOW, len(piece))
        x[:n] = symbols(piece)[:n]
        y[:n] = _tags(len(piece), spans)[:n]
        xs.append(x)
        ys.append(y)
    return np.stack(xs, axis=1), np.stack(ys, axis=1)


def train_tagger(texts: list[str], training: Training = Training()) -> Tagger:
    tagger = Tagger.new(N_SYMBOLS, 1 + 2 * len(KINDS), training.hidden, training.seed)
    tagger.train(*labelled_windows(texts, training, training.seed), training.rounds, seed=training.seed)
    return tagger


def _window_starts(text: str) -> list[int]:
    """Where the windows with a digit or at sign begin, of all that begin at multiples of
    ``STRIDE``."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    starts: list[int] = []
    found = _TRIGGER.search(text)
    while found:
        at = found.start()
        first = max(0, (at - WINDOW) // STRIDE + 1) * STRIDE
        upto = min(at // STRIDE * STRIDE, last)
        starts.extend(range(max(first, starts[-1] + STRIDE if starts else 0), upto + 1, STRIDE))
        # The next trigger that can bring a further window.
        found = _TRIGGER.search(text, max(at + 1, upto + STRIDE)) if upto < last else None
    return starts


def open_ends(text: str, tags: dict[int, np.ndarray]) -> list[int]:
    """The windows not yet read into which a span of a window that was read may go on."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    more = set()
    for start, own in tags.items():
        # Of the half that no other window reads, the place next to the edge.
        if start < last and start + STRIDE not in tags and own[WINDOW - 1] > 0:
            more.add(start + STRIDE)
        if start > 0 and start - STRIDE not in tags and own[0] > 0:
            more.add(start - STRIDE)
    return sorted(more)


def _accepted(kind: str, text: str) -> bool:
    digits = _NO_DIGIT.sub("", text)
    if kind == "card":
        return _is_card(text)
    if kind == "phone":
        return 8 <= len(digits) <= 15 and len(digits) < len(text) and len(digits) >= 0.6 * len(text)
    if kind == "ip":
        return bool(_OTHER_IP.fullmatch(text)) and all(int(x) <= 255 for x in re.findall("[0-9]+", text))
    return bool(_OTHER_EMAIL.fullmatch(text))


def added_spans(
    text: str, tags: dict[int, np.ndarray], base: list[tuple[str, int, int]]
) -> list[tuple[str, int, int]]:
    """The spans of the windows' tags, reconciled with each other and with the patterns'."""
    whole: dict[int, np.ndarray] = {}
    spans, run, out = [], [], []
    starts = sorted(tags)
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    # Runs of windows that overlap; each place by the window where it is farthest from an end.
    for i, start in enumerate(starts):
        begins = start == 0 or i == 0 or starts[i - 1] != start - STRIDE
        ends = start == last or i + 1 == len(starts) or starts[i + 1] != start + STRIDE
        lo = start if begins else start + _EDGE
        hi = min(start + WINDOW if ends else start + WINDOW - _EDGE, len(text))
        if begins:
            run = []
        run.append(tags[start][lo - start : hi - start])
        if begins:
            first = lo
        if ends:
            whole[first] = np.concatenate(run)
    for first, labels in whole.items():
        kinds = (labels + 1) // 2
        begins = (labels > 0) & (
            (labels % 2 == 1) | (np.concatenate([[0], kinds[:-1]]) != kinds)
        )
        for b in np.flatnonzero(begins):
            e = b + 1
            while e < len(kinds) and kinds[e] == kinds[b] and not begins[e]:
                e += 1
            spans.append((KINDS[kinds[b] - 1], first + int(b), first + int(e)))
    busy = [(s, e) for _, s, e in base]
    for kind, start, end in sorted(spans, key=lambda x: x[1:]):
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while start < end and not text[end - 1].isalnum():
            end -= 1
        # A span does not end inside a word or number.
        part = _WORDS if kind == "email" else _DIGITS
        while 0 < start < end and text[start - 1] in part:
            start -= 1
        while start < end < len(text) and text[end] in part:
            end += 1
        if start < end and all(e <= start or s >= end for s, e in busy) and _accepted(kind, text[start:end]):
            out.append((kind, start, end))
            busy.append((start, end))
    return out


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        *((f"n_{kind}", pa.int64()) for kind in KINDS),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)
_FOUND_SQL = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
_AT_ONCE = 1024


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", training: Training = Training()
) -> DataFrame:
    """Per document the number of pattern spans of each kind, a SHA-256 of those spans, and
    all spans as ``kind:start:end`` in code points, by kind, then start.

    Spans of the tagger are added only where the patterns found nothing. A null text is an
    empty one; a null id stays null; repeated rows each get their row; other columns are not
    looked at; an empty table gives no rows. The tagger is trained on at most
    ``training.documents`` documents, those with the smallest hashes of id and text.
    """
    spark = docs.sparkSession
    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    # The hashes are chosen first, so that tasks send no texts that are not wanted.
    own = F.xxhash64("doc_id", "text")
    last = chosen.select(own.alias("h")).orderBy("h").limit(training.documents).agg(F.max("h")).first()[0]
    sample = chosen.where(own <= F.lit(last)).limit(training.documents) if last is not None else chosen
    rows = sample.select(own.alias("h"), F.substring("text", 1, training.characters).alias("text")).collect()
    texts = [r["text"] for r in sorted(rows, key=lambda r: (r["h"], r["text"]))]
    shared = spark.sparkContext.broadcast(train_tagger(texts, training).parameters)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            base = list(map(base_spans, texts))
            tags: list[dict[int, np.ndarray]] = [{} for _ in texts]
            held: list[tuple[int, int]] = []
            windows: list[np.ndarray] = []

            def decode() -> None:
                for (i, start), found in zip(held, tagger.decode(np.stack(windows, axis=1)).T):
                    tags[i][start] = found
                held.clear()
                windows.clear()

            wanted = [(i, start) for i, text in enumerate(texts) for start in _window_starts(text)]
            while wanted:
                for i, start in wanted:
                    window = np.full(WINDOW, _PAD, np.uint8)
                    piece = symbols(texts[i][start : start + WINDOW])
                    window[: len(piece)] = piece
                    held.append((i, start))
                    windows.append(window)
                    if len(held) == _AT_ONCE:
                        decode()
                if held:
                    decode()
                read = dict.fromkeys(i for i, _ in wanted)
                wanted = [(i, start) for i in read for start in open_ends(texts[i], tags[i])]
            rows = []
            for doc_id, text, own, found in zip(batch.column(0).to_pylist(), texts, base, tags):
                counts = [sum(k == kind for k, _, _ in own) for kind in KINDS]
                more = added_spans(text, found, own)
                every = sorted(own + more, key=lambda s: (KINDS.index(s[0]), s[1]))
                digest = hashlib.sha256(joined(own).encode()).hexdigest()
                rows.append((doc_id, *counts, digest, joined(every)))
            columns = list(zip(*rows)) or [()] * len(_FOUND)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND
            )

    return chosen.mapInArrow(search, _FOUND_SQL)
