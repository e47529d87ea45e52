"""Small inputs that every operator has to take, and plain forms of what they compute."""

import re
import zlib

import public_tokenizers
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Columns whose names the operators use themselves.
CLASHES = ["row", "keep", "host", "text_key", "lines", "kind", "part", "rank", "fp", "word_chars", "n"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{name} string" for name in CLASHES
)


def awkward(spark):
    """Nulls in each column, empty and wordless texts, ties, repeated rows and a long text."""
    shared = "one line that is shared by several of these texts"
    prose = " ".join(f"w{i % 97}x{i % 89}" for i in range(120))
    texts = [
        (1, prose + "\n" + shared),
        (2, prose + "\n" + shared),
        (2, prose + "\n" + shared),
        (2, "another text under an id that is taken\n" + shared),
        (3, ""),
        (4, None),
        (5, " \t\n\n"),
        (None, shared),
        (None, None),
        (6, "tiny"),
        (7, " ".join(f"word{i * 7919 % 100_003}" for i in range(30_000)) + "\n" + shared),
        (8, "Ünï ço𝒹e   and\x0bodd\x0cwhite\xa0space"),
    ]
    rows = [
        (i, t, None if k % 3 else "en", None if k % 4 == 0 else "src", None, *["x"] * len(CLASHES))
        for k, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return text.translate(_AZ)


def words(text):
    return _WORD.findall(text or "")


def shingles(text, n):
    found = words(lower(text or ""))
    return [" ".join(found[i : i + n]) for i in range(max(len(found) - n + 1, 1))] if found else []


def tokens(name, text):
    tool = Tokenizer.from_file(public_tokenizers.path(name))
    tool.encode_special_tokens = True
    return [*tool.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def groups(n, linked):
    """The smallest member of each member's group."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [find(i) for i in range(n)]
