"""Operator 6: BPE encoding and decoding by a prefix-sharing trie traversal.

The words that a batch brings for the first time are put into a trie. Going through it depth
first, every node gets the last token of the encoding of its prefix, found from the nodes
above it, so a prefix that many words share is encoded once. A word's tokens are then read
back from its end. Words keep their encodings within a task; the texts are joined from them.

The vocabulary is a public file whose path is a parameter; it is read, never trained.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import in_batches, released, slices, table

ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
ENCODED_DDL = "doc_id long, ids binary, decoded string"

# A worker keeps at most this many chunks, and as many words; beyond it, it forgets the later
# half of them. Frequent ones come early.
HELD = 100_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files of this kind."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tokens and merges of a vocabulary file with an end-of-word suffix, keyed by id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(self.letters)}
        self.text = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.packed = {i: int(i).to_bytes(4, "little") for i in self.text}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = model["vocab"]
        # Tokens inside a word and at its end, by their bytes.
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.width: dict[int, int] = {}
        for token, i in ids.items():
            end = token.endswith(self.suffix) and len(token) > len(self.suffix)
            raw = bytes(byte_of[c] for c in (token[: -len(self.suffix)] if end else token) if c in byte_of)
            (self.final if end else self.inner)[raw] = i
            self.width[i] = len(raw)
        # Every prefix of a token, and by (longest such prefix at a node, next byte): that of the
        # next node, with the tokens that may end there, longest first. Filled as it is met.
        self.prefixes = {t[:n] for tokens in (self.inner, self.final) for t in tokens for n in range(len(t) + 1)}
        self.inner_steps: dict[bytes, tuple[bytes, list[int]]] = {}
        self.final_steps: dict[bytes, tuple[bytes, list[int]]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = ids[a], ids[b], ids[a + b]
            self.rank[left, right] = rank
            self.made[whole] = rank
            self.parts[whole] = (left, right)
        self.fits: dict[tuple[int, int], bool] = {}

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether merging leaves the tokens ``left`` and ``right`` side by side.

        Seen from the seam, the merge that came last is undone first. Had the pieces at the
        seam a merge with each other that comes earlier, it would have been made instead. Of
        equal merges the left one comes first.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        pair, bound, holds = (left, right), float("inf"), None
        while holds is None:
            if self.rank.get((left, right), bound) < bound:
                holds = False
                break
            a, b = self.made.get(left, -1), self.made.get(right, -1)
            if a < 0 and b < 0:
                holds = True
            elif a > b:
                bound, left = a, self.parts[left][1]
            else:
                bound, right = b + 1, self.parts[right][0]
        self.fits[pair] = holds
        return holds

    def step(self, met: bytes, tokens: dict[bytes, int], steps: dict) -> tuple[bytes, list[int]]:
        """What :attr:`prefixes` keeps for ``met``, the prefix at a node and the next byte."""
        ends = [tokens[met[i:]] for i in range(len(met)) if met[i:] in tokens]
        if not ends:
            raise ValueError("the vocabulary lacks a byte")
        if len(steps) > HELD:
            steps.clear()
        steps[met] = found = next(met[i:] for i in range(len(met) + 1) if met[i:] in self.prefixes), ends
        return found


def encode_words(vocab: Vocabulary, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
    """The tokens of each distinct word, in sorted order.

    In that order, words follow each other as in a depth-first walk of their trie: a word's
    nodes are its prefixes, and those it shares with the word before it are still on the path.
    """
    inner, final, width, fits = vocab.inner_steps, vocab.final_steps, vocab.width, vocab.fits
    last, met = [0], [b""]  # by depth: the last token of the encoding of the path so far
    before = b""
    for word in sorted(words):
        n = len(word)
        shared, most = 0, min(len(last) - 1, n - 1)
        if before[:most] == word[:most]:
            shared = most
        else:
            while before[shared] == word[shared]:
                shared += 1
        del last[shared + 1 :], met[shared + 1 :]
        state = met[shared]
        for depth in range(shared + 1, n + 1):
            key = state + word[depth - 1 : depth]
            if depth < n:
                state, ends = inner.get(key) or vocab.step(key, vocab.inner, inner)
            else:
                state, ends = final.get(key) or vocab.step(key, vocab.final, final)
            for token in ends:
                start = depth - width[token]
                if start == 0:
                    break
                pair = (last[start], token)
                holds = fits.get(pair)
                if vocab.stays_apart(*pair) if holds is None else holds:
                    break
            last.append(token)
            met.append(state)
        del last[n:], met[n:]
        ids, at = [token], n - width[token]
        while at:
            token = last[at]
            ids.append(token)
            at -= width[token]
        yield word, ids[::-1]
        before = word


class Encoder:
    """Encodes texts; keeps the encodings of the chunks between white space that it has met."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.vocab.special)) + ")")
        self.space = regex.compile(r"\s+")
        self.ids: dict[str, bytes] = {}
        self.out: dict[str, str] = {}
        self.words: dict[bytes, tuple[bytes, str]] = {}

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that are new, each distinct word among them once."""
        plain = {}
        for chunk in chunks:
            if not chunk.isascii():
                # Lower-casing is by character: a final capital sigma is an ordinary sigma.
                plain[chunk] = [w.encode() for w in self.split(unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower())]
            elif chunk.isalpha():
                plain[chunk] = [chunk.lower().encode()]
            else:
                plain[chunk] = [w.encode() for w in self.split(chunk.lower())]
        new = {w for words in plain.values() for w in words if w not in self.words}
        packed, names = self.vocab.packed.__getitem__, self.vocab.text.__getitem__
        for word, ids in encode_words(self.vocab, list(new)):
            self.words[word] = (b"".join(map(packed, ids)), " ".join(map(names, ids)))
        for chunk, words in plain.items():
            if len(words) == 1:
                self.ids[chunk], self.out[chunk] = self.words[words[0]]
            else:
                found = [self.words[w] for w in words]
                self.ids[chunk] = b"".join([f[0] for f in found])
                self.out[chunk] = " ".join([f[1] for f in found])

    def chunks(self, text: str) -> list[str]:
        # str.split also splits at the four separators U+001C..1F, which are no white space here.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in self.space.split(text) if c]
        return text.split()

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Packed little-endian ids, and the decoded text, of each text."""
        pieces = []
        for text in texts:
            parts = self.specials.split(text) if "<|" in text else [text]
            pieces.append([([p], True) if i % 2 else (self.chunks(p), False) for i, p in enumerate(parts)])
        for held in (self.ids, self.out, self.words):
            if len(held) > HELD:
                for key in list(held)[HELD // 2 :]:
                    del held[key]
        self.learn({c for parts in pieces for chunks, special in parts if not special for c in chunks}.difference(self.ids))
        return [self._joined(parts) for parts in pieces]

    def _joined(self, parts) -> tuple[bytes, str]:
        ids, out = [], []
        for chunks, special in parts:
            if special:
                ids.append(self.vocab.packed[self.vocab.special[chunks[0]]])
                out.append(chunks[0])
            elif chunks:
                ids.append(b"".join(map(self.ids.__getitem__, chunks)))
                out.append(" ".join(map(self.out.__getitem__, chunks)))
        return b"".join(ids), " ".join(o for o in out if o)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """A worker's encoder; Spark reuses workers, so later tasks find the words of earlier ones."""
    return Encoder(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        encoder = encoder_of(path)
        for batch in slices(batches):
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            first = size = 0
            for i, text in enumerate(texts):
                size += len(text)
                if size > 1 << 21 or i + 1 == len(texts):
                    for doc, (packed, decoded) in zip(ids[first : i + 1], encoder.encode(texts[first : i + 1])):
                        yield doc, packed, decoded
                    first, size = i + 1, 0

    yield from in_batches(rows(), ENCODED, 2)


def encode_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)`` per row: ids as packed little-endian unsigned 32-bit integers.

    The encoding is that of the vocabulary file without added special tokens at the ends; the
    strings of special tokens inside a text are those tokens. The file names no decoder, so
    decoding joins the tokens' strings by single spaces.

    A null text is an empty text and has no ids; a null id is kept; repeated rows are encoded
    each. Texts of any length are encoded whole, also one of a single very long word. Other
    columns are not read. An empty table gives an empty result. The file at ``path`` must be
    on every machine.
    """
    path = path or vocabulary_path()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: released(_encoded(batches, path)), ENCODED_DDL)


def digests(encoded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of :func:`encode_decode`'s rows."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


def query(spark, folder: str) -> DataFrame:
    return digests(encode_decode(table(spark, folder, "documents")))
