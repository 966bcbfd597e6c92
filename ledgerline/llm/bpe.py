"""Byte-pair encoding and decoding of whole texts by dynamic programming over prefixes.

The encoding of each prefix of a piece ends in exactly one token. An automaton over the vocabulary
names, after each byte, the tokens that the prefix ends with, longest first. Such a token is the last
one if the piece begins with it, or if it stands unchanged behind the last token of the prefix before
it: no merge across their border may come sooner than the merges that made the two. One table entry
for each prefix is enough; following it back from the end gives the ids, without merging anything.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import blocks

#: Pieces and pairs of tokens that a task keeps at hand; beyond, it begins anew.
KEPT = 1 << 17
#: Characters of a text that are split into pieces at a time.
PART = 1 << 20
#: A number above every token id, for keys of pairs.
IDS = 1 << 24


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: The published way to split a text into pieces.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{digit}+| ?{other}+|\s+(?!\S)|\s+"


def young_characters() -> str:
    """Letters and digits that `regex` knows and the tokenizers library does not yet, as ranges of a class.

    The two follow different editions of Unicode; what the library takes for neither, a vocabulary
    of this kind keeps among the other characters.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    unknown = "".join(c for c in map(chr, range(128, 0x110000)) if unicodedata.category(c) == "Cn")
    late = regex.findall(r"[\p{L}\p{N}]", unknown)
    seen = {a for _, (a, b) in split("".join(f"\n.{c}" for c in late)) if b - a == 2}
    young = [ord(c) for i, c in enumerate(late) if 3 * i + 1 in seen]
    begins = [c for c, before in zip(young, [-1, *young]) if c != before + 1]
    ends = [c for c, after in zip(young, [*young[1:], -1]) if c != after - 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(begins, ends, strict=True))


def splitters(young: str) -> tuple[regex.Pattern, re.Pattern | None, regex.Pattern]:
    """Pattern of pieces, what a text holds where that is not exact, and the pattern for such texts."""
    plain = regex.compile(SPLIT.format(letter=r"\p{L}", digit=r"\p{N}", other=r"[^\s\p{L}\p{N}]"))
    if not young:
        return plain, None, plain
    letter, digit = (rf"(?:(?![{young}])\p{{{x}}})" for x in "LN")
    careful = SPLIT.format(letter=letter, digit=digit, other=rf"(?:[^\s\p{{L}}\p{{N}}]|[{young}])")
    return plain, re.compile(f"[{young}]"), regex.compile(careful)


class Vocabulary:
    """Tokens, merges and the automaton of one byte-level vocabulary file.

    Raises ValueError for files whose result depends on more than merges: normalisation, prefix
    spaces, unknown tokens, or merges that use tokens made later.
    """

    def __init__(self, path: str):
        told = json.loads(Path(path).read_text())
        model, pre = told["model"], told["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or told["normalizer"] or not plain:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"]):
            raise ValueError("added tokens must stand for exactly their text")
        letters, ids = byte_letters(), model["vocab"]
        self.young = young_characters()
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.bytes = {i: bytes(letters[c] for c in t) if set(t) <= letters.keys() else t.encode() for t, i in (ids | self.special).items()}
        n = max(self.bytes) + 1
        self.size = [len(self.bytes.get(i, b"")) for i in range(n)]
        #: The two tokens a token is merged from, and when; -1 for single bytes.
        self.left, self.right, self.rank = [-1] * n, [-1] * n, [-1] * n
        self.pairs: dict[int, int] = {}
        for at, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            x, y, made = ids[a], ids[b], ids[a + b]
            if self.rank[made] >= 0 or (self.size[x] > 1 and self.rank[x] < 0) or (self.size[y] > 1 and self.rank[y] < 0):
                raise ValueError("each token must be made by one merge of tokens made before")
            self.left[made], self.right[made], self.rank[made] = x, y, at
            self.pairs[x * IDS + y] = at
        single = {self.bytes[i]: i for i in ids.values() if self.size[i] == 1}
        if len(single) < 256:
            raise ValueError("each byte must have a token")
        self._automaton(sorted((self.rank[i], i) for i in ids.values()))
        self.fitting: dict[int, bool] = {}

    def _automaton(self, tokens: list[tuple[int, int]]) -> None:
        """States are beginnings of tokens; `longest` is the longest token a state ends with."""
        self.next: dict[int, int] = {}
        own, depth, whole = [-1], [0], set()
        for rank, token in tokens:
            alone = rank < 0 or {self.left[token], self.right[token]} <= whole and self.fit(self.left[token], self.right[token], rank)
            if not alone or (rank < 0 and self.size[token] > 1):
                continue  # no text is ever encoded to it alone
            whole.add(token)
            state = 0
            for b in self.bytes[token]:
                after = self.next.setdefault(state << 8 | b, len(own))
                if after == len(own):
                    own.append(-1)
                    depth.append(depth[state] + 1)
                state = after
            own[state] = token
        self.back, self.longest, self.shorter = [0] * len(own), own, [-1] * len(self.size)
        for key, state in sorted(self.next.items(), key=lambda x: depth[x[1]]):
            before, b = key >> 8, key & 255
            back = self.back[before]
            while back and (back << 8 | b) not in self.next:
                back = self.back[back]
            self.back[state] = self.next.get(back << 8 | b, 0) if before else 0
            short = self.longest[self.back[state]]
            if own[state] < 0:
                self.longest[state] = short
            else:
                self.shorter[own[state]] = short

    def fit(self, x: int, y: int, limit: int | None = None) -> bool:
        """Whether tokens `x` and `y` side by side stay as they are, up to the merge `limit`.

        Merges are taken back one at a time, the latest first; between what is then next to the
        border no merge may have come sooner. Of one merge on both sides the left one came first.
        """
        left, right, rank, pairs = self.left, self.right, self.rank, self.pairs
        limit = len(rank) if limit is None else limit
        while pairs.get(x * IDS + y, limit) >= limit:
            a, b = rank[x], rank[y]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, x = a, right[x]
            else:
                limit, y = b + 1, left[y]
        return False

    def encode_pieces(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids of each of some pieces, 32-bit little-endian; in sorted order, what two neighbours begin with is done once."""
        next_, back, longest, shorter, size, fitting = self.next, self.back, self.longest, self.shorter, self.size, self.fitting
        packed = [i.to_bytes(4, "little") for i in range(len(size))]
        states, last, piece = [0], [-1], b""
        for before_it, piece in zip([b"", *pieces], pieces, strict=False):
            end = common(before_it, piece)
            del states[end + 1 :], last[end + 1 :]
            state = states[end]
            for b in piece[end:]:
                while (after := next_.get(state << 8 | b)) is None and state:
                    state = back[state]
                state = after or 0
                token = longest[state]
                end += 1
                while (before := last[end - size[token]]) >= 0:
                    key = before * IDS + token
                    fits = fitting.get(key)
                    if fits is None:
                        if len(fitting) >= KEPT:
                            fitting.clear()
                        fits = fitting[key] = self.fit(before, token)
                    if fits:
                        break
                    token = shorter[token]
                states.append(state)
                last.append(token)
            ids = []
            while end:
                token = last[end]
                ids.append(packed[token])
                end -= size[token]
            ids.reverse()
            yield b"".join(ids)


def common(x: bytes, y: bytes) -> int:
    """How many bytes the two begin with alike."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low = 0
    while n - low > 1:
        half = (low + n) // 2
        low, n = (half, n) if x[:half] == y[:half] else (low, half)
    return low


class Encoder:
    """Ids of whole texts, 32-bit little-endian."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known = vocabulary, {}
        self.plain, self.young, self.careful = splitters(vocabulary.young)
        self.special = {text: i.to_bytes(4, "little") for text, i in vocabulary.special.items()}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(names)})") if names else None
        #: A piece never goes on from another character to white space.
        self.border = regex.compile(r"(?<=\S)(?=\s)")

    def parts(self, text: str) -> Iterator[str]:
        begin = 0
        while len(text) - begin > PART:
            found = self.border.search(text, begin + PART)
            end = found.start() if found else len(text)
            yield text[begin:end]
            begin = end
        yield text[begin:] if begin else text

    def pieces(self, text: str) -> list[str]:
        exact = text.isascii() or not self.young or not self.young.search(text)
        return (self.plain if exact else self.careful).findall(text)

    def _learn(self, held: list[list[str]]) -> None:
        new = set().union(*held).difference(self.known)
        if len(self.known) + len(new) > 2 * KEPT:
            self.known.clear()
            new = set().union(*held)
        new = sorted((x.encode(), x) for x in new)
        for (_, piece), ids in zip(new, self.vocabulary.encode_pieces([x[0] for x in new]), strict=True):
            self.known[piece] = ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[list[bytes], list[str]]] = []
        chars = 0

        def flush() -> None:
            self._learn([pieces for _, pieces in held])
            for to, pieces in held:
                to.append(b"".join(map(self.known.__getitem__, pieces)))
            held.clear()

        for text, to in zip(texts, out, strict=True):
            special = any(x in text for x in self.special)
            for section in self.split.split(text) if special else (text,):
                if section in self.special:
                    flush()
                    to.append(self.special[section])
                    continue
                for part in self.parts(section):
                    held.append((to, self.pieces(part)))
                    chars += len(part)
                    if chars > PART:
                        flush()
                        chars = 0
        flush()
        return [b"".join(x) for x in out]


def decode(ids: bytes, of: dict[int, bytes]) -> str:
    """The text of ids; unknown ones stand for nothing, broken characters become U+FFFD."""
    numbers, out = np.frombuffer(ids, dtype="<u4"), bytearray()
    for at in range(0, len(numbers), PART):
        some = numbers[at : at + PART].tolist()
        try:
            out += b"".join(map(of.__getitem__, some))
        except KeyError:
            out += b"".join(of.get(i, b"") for i in some)
    return out.decode("utf-8", errors="replace")


def encode_texts(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(`id_column`, n_tokens, ids) of each row: `ids` is binary, unsigned 32-bit little-endian.

    Every row is encoded for itself, repeated rows and null ids too; a null or empty text has no ids.
    Added tokens in a text stand for themselves. Other columns are not looked at. The vocabulary file
    is read on the driver and travels with the tasks; memory grows with the longest text only.
    """
    vocabulary = Vocabulary(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary)
        for batch in blocks(batches, "text", PART):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            ids = encode([x.decode("utf-8", errors="replace") if x else "" for x in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["id", "n_tokens", "ids"],
            )

    given = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, n_tokens long, ids binary").withColumnRenamed("id", id_column)


def decode_ids(encoded: DataFrame, tokenizer_path: str, ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """`encoded` plus `text_column`, the text that `ids_column` stands for (null: null).

    Added tokens are kept. A column that has the name already is replaced.
    """
    of = Vocabulary(tokenizer_path).bytes
    kept = [c for c in encoded.columns if c != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "_ids", PART):
            texts = [None if x is None else decode(x, of) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, text_column])

    columns = [F.col(f"`{c}`") for c in kept]
    given = encoded.select(*columns, F.col(f"`{ids_column}`").alias("_ids"))
    schema = given.drop("_ids").schema.add(text_column, "string")
    return given.mapInArrow(run, schema)
