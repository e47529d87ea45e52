"""Token ids of many texts, by the tokenizers library and the public vocabulary files.

Encoding a corpus text by text takes the library about 2 MB/s. Most of that goes into
words seen before, so texts are cut where no token can cross, each distinct piece of a
batch goes to the library once, and the ids are gathered back in text order:

* byte-level vocabularies: at a single space between two characters that are no white
  space; the space goes to the piece behind it. Texts with other runs that hold a space go
  to the library whole;
* word vocabularies that drop white space and lower the case: at ASCII white space.

New pieces of common letters, digits and punctuation are cut on into the runs that these
vocabularies take apart, and each distinct run goes to the library's model alone, as most
of an encoding's time goes into what surrounds it. All others are encoded as texts.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, normalizers

# Spark gives each task one core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END_ID = 2
_WHITE = r"[\t-\r\x1c-\x20\x{85}\pZ]"
_SPACED_RUN = f"{_WHITE} | {_WHITE}"
#: Pieces in each of the two generations that one worker keeps, and the longest that is
#: kept. They bound memory only: what is not kept is encoded again.
KEPT_PIECES, KEPT_CHARS = 150_000, 48
#: Characters that are cut up at once; also only for memory. A longer text is one batch.
BATCH_CHARS = 12_000_000
#: Stands between pieces that go to the library as one text.
_MARK = "\x01"
_JOINED = 256
#: Letters whose lower case is one letter whatever stands beside it, and punctuation without
#: the apostrophe, which can begin a run of its own kind.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿА-Яа-яЁё"
_PUNCTUATION = r"!-&(-/:-@\[-`{-~"
_KNOWN = f"[{_LETTERS}0-9{_PUNCTUATION}]+"
#: By kind of vocabulary, ``words`` or not: pieces that are runs throughout, a group where they
#: are a single one, and their runs.
_SIMPLE = {
    True: re.compile(f"([{_LETTERS}]+)|{_KNOWN}"),
    False: re.compile(f"( ?[{_LETTERS}]+)| ?{_KNOWN}(?:\n{_KNOWN})*"),
}
_RUN = {
    True: re.compile(f"[{_LETTERS}]+|[0-9]|[{_PUNCTUATION}]+"),
    False: re.compile(f" ?(?:[{_LETTERS}]+|[0-9]+|[{_PUNCTUATION}]+)|\n"),
}
_PROBES = ["Où", " Où", "a1234567b", " Ёж.,x", "12", " ...A--b7", "(a)[b]{c}_d^e~`", "A-<|endoftext|>", "Ab,\nCÉ.\n34", " <a"]
#: Pieces whose runs are held at once.
_AT_ONCE = 50_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable characters for
    themselves, and those from U+0100 on for the rest, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts for one vocabulary file; ``words``: a word vocabulary as above."""

    def __init__(self, path: str, words: bool):
        self._words = words
        self._whole = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text in a text.
        self._whole.encode_special_tokens = True
        self._plain = self._whole
        if words:
            # For pieces that the other two normalisers leave as they are.
            self._plain = Tokenizer.from_file(path)
            self._plain.encode_special_tokens = True
            self._plain.normalizer = normalizers.Lowercase()
        mark = self._whole.encode(_MARK, add_special_tokens=False)
        self._mark = mark.ids[0] if len(mark.ids) == 1 else None
        letter = self._whole.pre_tokenizer.pre_tokenize_str(_MARK)[0][0]
        if sum(letter in token for token in self._whole.get_vocab()) > 1 + words:
            self._mark = None  # it could merge with its neighbours
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._model = self._whole.model
        self._letters = {b: letter for letter, b in byte_letters().items()}
        # Vocabularies that take other runs apart have all their pieces encoded as texts.
        probes = [x for x in map(_SIMPLE[words].fullmatch, _PROBES) if x]
        plain = [self._whole.encode(x[0], add_special_tokens=False).ids for x in probes]
        self._has_runs = [np.frombuffer(x, "<u4").tolist() for x in self._by_runs(probes)] == plain

    def _run_ids(self, runs: list[str]) -> list[bytes]:
        if not runs:
            return []
        text = _MARK.join(runs)
        text = (text.lower() if self._words else text).encode().decode("latin-1")
        ids: list[int] = []
        ends = [0]
        for run in text.translate(self._letters).split(self._letters[ord(_MARK)]):
            ids += [token.id for token in self._model.tokenize(run)]
            ends.append(4 * len(ids))
        data = np.array(ids, dtype="<u4").tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _by_runs(self, pieces: list[re.Match]) -> list[bytes]:
        out: list[bytes] = []
        known: dict[str, bytes] = {}
        cut = _RUN[self._words].findall
        for begin in range(0, len(pieces), _AT_ONCE):
            runs = [(x[0],) if x.lastindex else cut(x[0]) for x in pieces[begin : begin + _AT_ONCE]]
            new = list(dict.fromkeys(chain.from_iterable(runs)).keys() - known.keys())
            known.update(zip(new, self._run_ids(new)))
            out += [
                known[some[0]] if len(some) == 1 else b"".join([known[x] for x in some]) for some in runs
            ]
        return out

    def _can_join(self, piece: str) -> bool:
        """Whether the ids stay the same with the mark beside the piece."""
        if self._mark is None or not piece or piece[-1].isspace() or _MARK in piece:
            return False
        if not self._words:
            return piece[0] != "'"  # where it begins a run, "'s" is a token of its own
        if piece.isascii():
            return True
        return unicodedata.is_normalized("NFC", piece) and len(piece.split()) == 1

    def _encode_new(self, pieces: list[str]) -> list[bytes]:
        if not self._has_runs:
            return self._as_texts(pieces)
        simple = list(map(_SIMPLE[self._words].fullmatch, pieces))
        by_runs = iter(self._by_runs([found for found in simple if found]))
        as_texts = iter(self._as_texts([x for x, found in zip(pieces, simple) if not found]))
        return [next(by_runs if found else as_texts) for found in simple]

    def _as_texts(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        joined = [i for i, x in enumerate(pieces) if self._can_join(x)]
        runs = [joined[i : i + _JOINED] for i in range(0, len(joined), _JOINED)]
        between = f" {_MARK} " if self._words else _MARK
        for begin in range(0, len(runs), 64):
            some = runs[begin : begin + 64]
            texts = [between.join([pieces[i] for i in run]) for run in some]
            for run, found in zip(
                some, self._plain.encode_batch_fast(texts, add_special_tokens=False)
            ):
                ids = np.array([*found.ids, self._mark], dtype="<u4")
                data, at = ids.tobytes(), 0
                for i, end in zip(run, (np.flatnonzero(ids == self._mark) * 4).tolist()):
                    out[i] = data[at:end]
                    at = end + 4
        if len(joined) < len(pieces):
            for i in set(range(len(pieces))) - set(joined):
                ids = self._whole.encode(pieces[i], add_special_tokens=False).ids
                out[i] = np.array(ids, dtype="<u4").tobytes()
        return out

    def _ids(self, pieces: list[str]) -> list[bytes]:
        if len(self._new) > KEPT_PIECES:
            self._old, self._new = self._new, {}
        new, old = self._new, self._old
        found = list(map(new.get, pieces))
        lacking = [i for i, x in enumerate(found) if x is None]
        again = list(map(old.get, [pieces[i] for i in lacking]))
        for i, x in zip(lacking, again):
            if x is not None:
                found[i] = new[pieces[i]] = x
        lacking = [i for i, x in zip(lacking, again) if x is None]
        for i, x in zip(lacking, self._encode_new([pieces[i] for i in lacking])):
            found[i] = x
            if len(pieces[i]) <= KEPT_CHARS:
                new[pieces[i]] = x
        return found

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
        begin, n = 0, len(texts)
        while begin < n:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + BATCH_CHARS, "right")))
            yield from self._encode(texts.slice(begin, end - begin))
            begin = end

    def _encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if self._words:
            # A lone full stop or comma behind a letter is a token of its own.
            cut = pc.replace_substring_regex(pc.ascii_lower(texts), r"(\pL)([.,])([ \n])", r"\1 \2\3")
            lists = pc.ascii_split_whitespace(cut)
        else:
            odd = pc.match_substring_regex(texts, _SPACED_RUN)
            if pc.any(odd).as_py():
                whole = (np.frombuffer(x, "<u4") for x in self._ids(texts.filter(odd).to_pylist()))
                rest = self._encode(texts.filter(pc.invert(odd)))
                yield from (next(whole if x else rest) for x in odd.to_pylist())
                return
            lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        # By numpy, which makes strings several times faster than ``to_pylist``.
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy()
        if not self._words:
            # All but a text's first piece have the space before them.
            where = at[:-1][at[1:] > at[:-1]]
            firsts, own = np.unique(codes[where], return_inverse=True)
            codes = codes.copy()
            codes[where] = own + len(pieces)
            pieces = [" " + x for x in pieces] + [pieces[c] for c in firsts.tolist()]
        ids = self._ids(pieces)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        starts = np.cumsum(sizes) - sizes
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            own = codes[a:b]
            took = sizes[own]
            to = np.cumsum(took)
            n = int(to[-1]) if len(to) else 0
            yield flat[np.repeat(starts[own] - (to - took), took) + np.arange(n)]


@lru_cache(maxsize=2)
def encoder(name: str, words: bool) -> Encoder:
    """One per worker process; ``name`` is a file of the public tokenizers, or a path."""
    return Encoder(name if "/" in name else public_tokenizers.path(name), words)
