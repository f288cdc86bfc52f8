"""Byte-level BPE encoding and decoding (operator 3).

Encoding cuts a text into pieces by the vocabulary's split pattern and
encodes each piece by a backtracking walk: an Aho-Corasick automaton
over all tokens gives, at every offset, the longest token that starts
there; a token is taken if it may stand after the one before it, which a
table of the vocabulary's own merges decides; if not, the next shorter
token that is a prefix is tried, and when none is left the walk steps
back and marks the offset as a dead end.  No offset is left twice, so
the work is linear in the piece, and the result is that of applying the
merges one by one.  Decoding copies every token's bytes out of one blob
through a table of offsets.

The vocabulary file is read on the driver and broadcast: its size (about
1.5 MB) does not depend on the data.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.llm.common import named, ship, slices

#: Fixed value: the split pattern of this family of vocabularies.  Its
#: alternatives exclude one another by their first characters, so the most
#: frequent one may stand first, and none ever needs to give a character back.
SPLIT_PATTERN = r" ?\p{L}++|'(?:[stmd]|re|ve|ll)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"

#: The classes of characters in the pattern, and a character of the two that versions of Unicode add to.
CLASSES, MEMBER = {"L": r"\p{L}", "N": r"\p{N}", "other": r"[^\s\p{L}\p{N}]"}, {"L": "a", "N": "1"}
#: Code points that letters and numbers are among (the planes with characters), and how many are tested together.
PLANES, TESTED_AT_ONCE = (range(0xD800), range(0xE000, 0x40000), range(0xE0000, 0xE1000)), 20_000

#: Pieces remembered per worker, and the longest piece worth remembering.
CACHE_PIECES, CACHE_CHARS = 300_000, 48


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _ranges(code_points: list[int]) -> str:
    """Ascending code points as the inside of a character class."""
    out, at = [], 0
    while at < len(code_points):
        end = at
        while end + 1 < len(code_points) and code_points[end + 1] == code_points[end] + 1:
            end += 1
        out.append(f"\\U{code_points[at]:08x}-\\U{code_points[end]:08x}")
        at = end + 1
    return "".join(out)


@lru_cache(maxsize=2)
def differing_classes(spec: str) -> dict[str, tuple[str, str]]:
    """Where the vocabulary's own splitter and the pattern's classes part, as (left out, added) ranges of each class.

    The two follow different versions of Unicode.  Every code point is put
    behind a letter and a digit: it is of the class with which the splitter
    keeps it in one piece.  A second or so, on the driver.
    """
    from tokenizers import Tokenizer
    splitter = Tokenizer.from_str(spec).pre_tokenizer
    every = [*chain.from_iterable(PLANES)]
    less, more = {}, {}
    for name, before in MEMBER.items():
        theirs = set()
        for at in range(0, len(every), TESTED_AT_ONCE):
            some = every[at:at + TESTED_AT_ONCE]
            starts = {a for _, (a, _) in splitter.pre_tokenize_str("".join(f"{before}{chr(c)}\n" for c in some))}
            theirs.update(c for i, c in enumerate(some) if 3 * i + 1 not in starts)
        own = {ord(c) for c in regex.findall(CLASSES[name], "".join(map(chr, every)))}
        less[name], more[name] = own - theirs, theirs - own
    gone, new = set.union(*less.values()), set.union(*more.values())
    less["other"], more["other"] = new - gone, gone - new
    return {name: (_ranges(sorted(less[name])), _ranges(sorted(more[name]))) for name in CLASSES}


def exact_pattern(differing: dict[str, tuple[str, str]]) -> str:
    """``SPLIT_PATTERN`` with the classes of the vocabulary's own splitter (of ``regex``'s version 1 sets)."""
    def class_(name: str) -> str:
        left_out, added = differing[name]
        base = CLASSES[name]
        base = f"[{base}--[{left_out}]]" if left_out else base
        return f"[{base}||[{added}]]" if added else f"[{base}]"

    letter, number, other = map(class_, CLASSES)
    space = f"[^{letter}{number}{other}]"
    return (rf" ?{letter}++|'(?:[stmd]|re|ve|ll)| ?{number}++| ?{other}++"
            rf"|{space}+(?=\Z|{space})|{space}+")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files.

    Printable Latin-1 characters stand for themselves; the other bytes,
    in order, for the characters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """The tables of one vocabulary file, built once per Python worker."""

    def __init__(self, spec: str, differing: dict[str, tuple[str, str]]):
        model = json.loads(spec)
        symbols = byte_symbols()
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        vocab = {t: i for t, i in model["model"]["vocab"].items() if t not in special}
        size = max([*vocab.values(), *special.values()]) + 1
        self.token = [b""] * size
        for t, i in vocab.items():
            self.token[i] = bytes(symbols[c] for c in t)
        for t, i in special.items():
            self.token[i] = t.encode()
        self.pair: dict[tuple[int, int], int] = {}
        self.rank = list(range(size))
        self.halves = [(i, i) for i in range(size)]
        for order, merge in enumerate(model["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            whole = vocab[left + right]
            if (vocab[left], vocab[right]) not in self.pair:
                self.pair[vocab[left], vocab[right]] = whole
                self.halves[whole] = (vocab[left], vocab[right])
                self.rank[whole] = order + 256
        merged = [i for i in vocab.values() if self.halves[i] != (i, i)]
        if sorted(merged, key=self.rank.__getitem__) != sorted(merged) or any(
                i < j for i in merged[:1] for j in vocab.values() if self.halves[j] == (j, j) and j > 255):
            raise ValueError("the pair check needs token ids in the order of the merges")
        known = {self.token[i]: i for i in vocab.values()}
        self.shorter = [next((known[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in known), -1)
                        for t in self.token]
        self.match = ahocorasick.Automaton()
        for t, i in known.items():
            self.match.add_word(t.decode("latin-1"), i)
        self.match.make_automaton()
        self.usual = regex.compile(SPLIT_PATTERN).findall
        odd = "".join(map("".join, differing.values()))
        #: Characters whose class differs; those of Latin-1 are the same in every version.
        self.odd = frozenset(regex.findall(f"[{odd}]", "".join(map(chr, chain.from_iterable(PLANES))))) if odd else None
        self.exact = regex.compile(exact_pattern(differing), regex.V1).findall if odd else None
        self.special = special
        self.special_split = (regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
                                            + ")").split if special else None)
        self.blob = np.frombuffer(b"".join(self.token), dtype=np.uint8)
        self.size = [len(t) for t in self.token]
        self.length = np.array(self.size, dtype=np.int32)
        self.offset = np.concatenate(([0], np.cumsum(self.length)[:-1])).astype(np.int32)
        self._may_follow: dict[int, bool] = {}
        self.pieces = _Pieces(self)

    def split(self, text: str) -> list[str]:
        """The pieces of a text, as the vocabulary's own splitter cuts it."""
        if self.odd is None or _latin(text) or self.odd.isdisjoint(text):
            return self.usual(text)
        return self.exact(text)

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging would leave these two tokens as they stand, side by side."""
        key = left << 32 | right
        known = self._may_follow.get(key)
        if known is None:
            if len(self._may_follow) >= 500_000:
                self._may_follow.clear()
            known = self._may_follow[key] = self._compatible(left, right)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        """Undo merges at the seam, latest first; a merge across it that comes earlier forbids the pair."""
        bound = len(self.token) + 1
        while True:
            across = self.pair.get((a, b))
            if across is not None and across < bound:
                return False
            if a > b:
                bound = a
                a = self.halves[a][1]
                if a == bound:  # a is a single byte: nothing left to undo on this side
                    bound, b = b + 1, self.halves[b][0]
                    if b + 1 == bound:
                        return True
            else:
                bound = b + 1
                b = self.halves[b][0]
                if b + 1 == bound:
                    bound, a = a, self.halves[a][1]
                    if a == bound:
                        return True

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Token ids of one piece, by the backtracking walk."""
        raw = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        n, size, shorter, may_follow = len(raw), self.size, self.shorter, self.may_follow
        longest = [-1] * (n + 1)
        for end, token in self.match.iter(raw):  # ends ascend, so the last match of a start is its longest
            longest[end + 1 - size[token]] = token
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + size[token]
                if alive[end] and (last < 0 or may_follow(last, token)):
                    out.append(token)
                    last, at = token, end
                    token = longest[end]
                    break
                token = shorter[token]
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                alive[at] = 0
                token = out.pop()
                last = out[-1] if out else -1
                at -= size[token]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Token ids of a text; strings of special tokens become their ids."""
        if not self.special_split or not any(s in text for s in self.special):
            return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))
        out: list[int] = []
        for part in self.special_split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out.extend(chain.from_iterable(map(self.pieces.__getitem__, self.split(part))))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids: slices of the blob, found through the offset table."""
        if not len(ids):
            return ""
        size = self.length[ids]
        ends = np.cumsum(size, dtype=np.int64)
        kind = np.int32 if ends[-1] < 1 << 31 else np.int64
        take = np.arange(int(ends[-1]), dtype=kind)
        take += np.repeat((self.offset[ids] - (ends - size)).astype(kind), size)
        return self.blob[take].tobytes().decode("utf-8", "replace")


class _Pieces(dict):
    """Pieces already encoded; bounded, and emptied when full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.vocabulary.encode_piece(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _vocabulary(spec: str, differing: tuple) -> Vocabulary:
    return Vocabulary(spec, dict(differing))


def _shared(spark: SparkSession, vocabulary_path: str):
    """What workers build their tables from, broadcast."""
    spec = read_vocabulary(vocabulary_path)
    return spark.sparkContext.broadcast((spec, tuple(differing_classes(spec).items())))


def read_vocabulary(path: str) -> str:
    """The vocabulary file's content; it lies beside the program, not in the data store."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with its text column replaced by ``ids_col``, the token ids of the whole text.

    With ``decoded_col``, also the text decoded from these ids, in the same
    pass: one Python worker a task instead of two, and no ids sent back.

    A null or empty text has no tokens.  All other columns are kept as
    they are, but those named like the new ones give way to them; one
    row comes out per row, repeated rows too.  One task holds a batch of
    rows at a time, at least one whole text.
    """
    new = [ids_col, *([decoded_col] if decoded_col else [])]
    rest = [c for c in docs.columns if c.lower() not in {x.lower() for x in (text_col, *new)}]
    ship(docs.sparkSession)
    shared = _shared(docs.sparkSession, vocabulary_path)
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(ids_col, T.ArrayType(T.IntegerType())),
                           *([T.StructField(decoded_col, T.StringType())] if decoded_col else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(*shared.value)
        for batch in batches:
            for part in slices(batch, text_col):
                ids = [vocabulary.encode(t or "") for t in part.column(text_col).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(ends[-1]))
                columns = [*(part.column(c) for c in rest),
                           pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decoded_col:
                    columns.append(pa.array([vocabulary.decode(flat[a:b]) for a, b in
                                             zip(ends[:-1], ends[1:], strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*rest, *new])

    return docs.select(*map(named, rest), named(text_col)).mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``tokens`` with a column ``text_col`` added: the text its ids stand for.

    Bytes that are not UTF-8 become U+FFFD; special tokens are written
    out.  Null ids count as none; a null or unknown id raises.  A column
    that is named like ``text_col`` gives way to it.
    """
    tokens = tokens.select(*(named(c) for c in tokens.columns if c.lower() != text_col.lower()))
    ship(tokens.sparkSession)
    shared = _shared(tokens.sparkSession, vocabulary_path)
    schema = T.StructType([*tokens.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(*shared.value)
        for batch in batches:
            column = batch.column(ids_col)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            null = column.is_null().to_pylist()
            texts = ["" if n else vocabulary.decode(flat[a:b])
                     for a, b, n in zip(ends[:-1], ends[1:], null, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, text_col])

    return tokens.mapInArrow(run, schema)


def token_digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per document: token count, and SHA-256 of the ids written in decimal and of the text decoded from them."""
    ids = encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), vocabulary_path,
                 decoded_col="text")
    return ids.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"))
