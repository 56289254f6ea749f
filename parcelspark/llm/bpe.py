"""BPE encoding and decoding: greedy longest match proposes tokens, pair checks verify them, failing words are merged exactly.

A list of tokens is what byte-pair merging gives if each token merges to itself and each two neighbours are compatible, that is,
if no merge across their border would have come before the merges that made them. So a proposal needs no merging, only a
check of its pairs, which is done for all distinct words of many texts at a time.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# How the byte-level vocabularies cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same for texts of ASCII only, in the faster standard library.
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

# Letters and numbers that came after the Unicode version of the public tokenizers, where they are neither.
LATER_LETTERS = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB"
    r"\U00011DF1\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA"
    r"\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168"
    r"\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE"
    r"\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF"
    r"\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F")
LATER_NUMBERS = r"\U00011DE0-\U00011DE9\U0001246F\U00012475-\U0001247F\U00012550-\U00012686"

#: Characters of text worked on at a time; a longer text is cut where a word surely begins.
PIECE = 1 << 20
#: Words whose tokens a task remembers; it starts anew beyond that, so this bounds memory and nothing else.
REMEMBERED = 1 << 18
#: Failing words of up to so many bytes are merged together, one merge of each a round; longer ones by a heap each.
SHORT = 48
NEVER = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, then those from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, merges by rank, special strings, and what is derived from them. Its size is that of the vocabulary file."""

    tokens: list[bytes]
    left: np.ndarray  # of each token, the two it is merged from (-1 for a byte)
    right: np.ndarray
    rank: np.ndarray  # of the merge that makes a token; -1 for a byte
    product: np.ndarray  # the token that a merge makes, by rank
    pair_keys: np.ndarray  # left << 32 | right of all merges, sorted
    pair_ranks: np.ndarray
    edges: np.ndarray  # prefix tree of the tokens: node << 8 | byte, sorted
    targets: np.ndarray
    ends: np.ndarray  # the token that ends at a node, or -1
    specials: dict[str, int]

    @cached_property
    def ranks(self) -> dict[int, int]:
        return dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist()))

    @cached_property
    def byte_ids(self) -> list[int]:
        return [int(i) for i in self.ends[self.targets[np.searchsorted(self.edges, np.arange(256))]]]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank at which two tokens merge, or NEVER."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge across the border of a and b (of a rank below ``before``) comes before those that made them.

        The merges of both tokens next to the border are undone, the latest first. At each step the two tokens there stood side by
        side until the merge undone last, so a merge of them must not have a smaller rank; of equal ones the left goes first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NEVER) if before is None else before.astype(np.int64)
        fits = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            crossed = self.rank_of(a, b) < limit
            fits[live[crossed]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            go = ~crossed & ((rank_a >= 0) | (rank_b >= 0))
            live, a, b, rank_a, rank_b = live[go], a[go], b[go], rank_a[go], rank_b[go]
            of_a = rank_a > rank_b
            limit = np.where(of_a, rank_a, rank_b + 1)
            a, b = np.where(of_a, self.right[a], a), np.where(of_a, b, self.left[b])
        return fits

    def longest(self, data: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The longest token that begins at each byte and ends by ``end``."""
        found = np.zeros(len(data), np.int64)
        at, node, depth = np.arange(len(data)), np.zeros(len(data), np.int64), 0
        while len(at):
            key = node << 8 | data[at + depth]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[edge] == key
            at, node = at[hit], self.targets[edge[hit]]
            token = self.ends[node]
            found[at[token >= 0]] = token[token >= 0]
            depth += 1
            inside = at + depth < end[at]
            at, node = at[inside], node[inside]
        return found

    def proposed(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of the words: number of the word and token, in order."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(size)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        token = self.longest(data, np.repeat(stop, size))
        length = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))[token]
        word, at = np.flatnonzero(size), (stop - size)[size > 0]
        numbers, found = [], []
        while len(at):
            numbers.append(word)
            found.append(token[at])
            at = at + length[at]
            more = at < stop[word]
            word, at = word[more], at[more]
        number = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        order = np.argsort(number, kind="stable")
        return number[order], (np.concatenate(found) if found else number)[order]

    def merged(self, word: bytes) -> list[int]:
        """Tokens of a word by merging, the lowest rank first and the leftmost of equal ones."""
        ids = [self.byte_ids[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(r, i) for i in range(n - 1) if (r := self.ranks.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(waiting)
        while waiting:
            r, i = heapq.heappop(waiting)
            j = after[i]
            if ids[i] < 0 or j == n or self.ranks.get(ids[i] << 32 | ids[j]) != r:
                continue  # one of the two has gone into another merge
            ids[i], ids[j], after[i] = int(self.product[r]), -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (s := self.ranks.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(waiting, (s, x))
        return [t for t in ids if t >= 0]

    def merged_together(self, words: list[bytes]) -> list[bytes]:
        """As ``merged``, one merge of each word a round, with packed ids: for many short words."""
        out = [b""] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.array(self.byte_ids, np.int64)[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)

        def ranks(at: np.ndarray) -> np.ndarray:
            after = np.minimum(at + 1, len(ids) - 1)
            return np.where((after > at) & (word[after] == word[at]), self.rank_of(ids[at], ids[after]), NEVER)

        rank = ranks(np.arange(len(ids)))
        while len(ids):
            start = np.flatnonzero(np.diff(word, prepend=-1))
            low = np.minimum.reduceat(rank, start)
            size = np.diff(np.append(start, len(ids)))
            done = np.repeat(low == NEVER, size)
            if done.any():
                packed = ids[done].astype("<u4").tobytes()
                ready = low == NEVER
                stops = (np.cumsum(size[ready]) * 4).tolist()
                for i, a, b in zip(word[start[ready]].tolist(), [0, *stops], stops):
                    out[i] = packed[a:b]
                ids, word, rank = ids[~done], word[~done], rank[~done]
                low, size = low[~ready], size[~ready]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, size))
            at = hit[np.diff(word[hit], prepend=-1) != 0]  # the leftmost of each word
            ids[at] = self.product[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one place of each earlier word is gone
            ids, word, rank = ids[keep], word[keep], rank[keep]
            rank[at] = ranks(at)
            before = at[at > 0] - 1
            rank[before] = ranks(before)
        return out

    def encoded_words(self, words: list[bytes]) -> list[bytes]:
        """Each word's ids as little-endian unsigned 32-bit integers."""
        number, token = self.proposed(words)
        side = np.flatnonzero(number[1:] == number[:-1])
        pair, which = np.unique(token[side] << 32 | token[side + 1], return_inverse=True)
        bad = ~self.compatible(pair >> 32, pair & 0xFFFFFFFF)[which]
        failing = np.unique(number[side[bad]]).tolist()
        short = [i for i in failing if len(words[i]) <= SHORT]
        merged = dict(zip(short, self.merged_together([words[i] for i in short])))
        merged |= {i: np.array(self.merged(words[i]), "<u4").tobytes() for i in failing if len(words[i]) > SHORT}
        packed = token.astype("<u4").tobytes()
        stop = np.searchsorted(number, np.arange(len(words)), "right") * 4
        out, start = [], 0
        for i, end in enumerate(stop.tolist()):
            out.append(merged[i] if i in merged else packed[start:end])
            start = end
        return out


def build_vocabulary(tokens: list[bytes], merges: list[tuple[int, int]], specials: dict[str, int]) -> Vocabulary:
    """A vocabulary of ``tokens`` by id (a special id has its string) and ``merges`` (pairs of ids), the first merged first.

    Every byte must be a token and every merge must make a token of its own. Tokens that merging their own bytes would not
    give are never proposed.
    """
    ids = {t: i for i, t in enumerate(tokens) if i not in set(specials.values())}
    if any(bytes([b]) not in ids for b in range(256)):
        raise ValueError("each byte must be a token")
    n = len(tokens)
    left, right, rank = (np.full(n, -1, np.int64) for _ in range(3))
    product = np.array([ids[tokens[a] + tokens[b]] for a, b in merges], np.int64)
    if len(np.unique(product)) < len(product):
        raise ValueError("two merges make the same token")
    if merges:
        left[product], right[product] = np.array(merges, np.int64).T
    rank[product] = np.arange(len(merges))
    keys = left[product] << 32 | right[product] if merges else np.array([-1])
    order = np.argsort(keys)

    child: dict[int, int] = {}
    ends = [-1]
    for token, i in ids.items():
        node = 0
        for b in token:
            node = child.setdefault(node << 8 | b, len(ends))
            if node == len(ends):
                ends.append(-1)
        ends[node] = i
    edges = np.array(sorted(child), np.int64)
    targets = np.array([child[e] for e in edges.tolist()], np.int64)
    made = Vocabulary(tokens, left, right, rank, product, keys[order], order.astype(np.int64), edges, targets, np.array(ends, np.int64),
                      specials)
    # a token merges to itself if its two parts do and may stand side by side until its own merge
    sound = np.zeros(n, bool)
    sound[[ids[bytes([b])] for b in range(256)]] = True
    alone = made.compatible(left[product], right[product], np.arange(len(merges)))
    for token, a, b, fits in zip(product.tolist(), left[product].tolist(), right[product].tolist(), alone.tolist()):
        sound[token] = fits and sound[a] and sound[b]
    listed = made.ends >= 0
    made.ends[listed] = np.where(sound[made.ends[listed]], made.ends[listed], -1)
    return made


def load_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE file (JSON) of the tokenizers library, read on the driver. Other kinds and settings raise."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    model, cut, added = raw["model"], raw["pre_tokenizer"] or {}, raw["added_tokens"]
    usual = (model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
             and not cut.get("add_prefix_space") and not raw["normalizer"] and (raw["decoder"] or {}).get("type") == "ByteLevel")
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
           if model.get(k)]
    if not usual or odd or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"not a plain byte-level BPE file: {path}")
    letters = byte_letters()
    specials = {t["content"]: t["id"] for t in added}
    tokens = [b""] * (1 + max([*model["vocab"].values(), *specials.values()]))
    for text, i in model["vocab"].items():
        tokens[i] = text.encode() if text in specials else bytes(letters[c] for c in text)
    for text, i in specials.items():
        tokens[i] = text.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return build_vocabulary(tokens, [(model["vocab"][a], model["vocab"][b]) for a, b in pairs], specials)


class Encoder:
    """Encodes texts in one task and remembers the tokens of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.of_special = {(i,): np.array([i], "<u4").tobytes() for i in vocabulary.specials.values()}
        self.known: dict = dict(self.of_special)
        longest_first = sorted(vocabulary.specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.words = regex.compile(WORDS)
        self.ascii_words = re.compile(ASCII_WORDS, re.ASCII)
        self.high = re.compile("[\u0558-\U0010FFFF]")
        later = LATER_LETTERS + LATER_NUMBERS
        self.later = regex.compile(f"[{later}]")
        self.older_words = regex.compile(
            r"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}--[%s]]+| ?[\p{N}--[%s]]+| ?(?:[^\s\p{L}\p{N}]|[%s])+|\s+(?!\S)|\s+"
            % (LATER_LETTERS, LATER_NUMBERS, later))
        self.border = regex.compile(r"(?<=\S)\s")

    def pieces(self, text: str) -> Iterator[str | tuple]:
        """A text without its special strings, cut into pieces at places where a word begins; a special string as (id,)."""
        for part in self.special.split(text) if self.special else [text]:
            if part in self.vocabulary.specials:
                yield (self.vocabulary.specials[part],)
                continue
            start = 0
            while len(part) - start > PIECE and (cut := self.border.search(part, start + PIECE)):
                yield part[start:cut.start()]
                start = cut.start()
            if start < len(part):
                yield part[start:]

    def words_of(self, piece: str | tuple) -> list:
        if isinstance(piece, tuple):
            return [piece]
        if piece.isascii():
            return self.ascii_words.findall(piece)
        later = self.high.search(piece) and self.later.search(piece)
        return (self.older_words if later else self.words).findall(piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting, size = [], 0
        for i, text in enumerate(texts):
            for piece in self.pieces(text):
                waiting.append((i, self.words_of(piece)))
                size += len(piece)
                if size > 2 * PIECE:
                    self._settle(waiting, out)
                    waiting, size = [], 0
        self._settle(waiting, out)
        return [b"".join(x) for x in out]

    def _settle(self, waiting: list[tuple[int, list]], out: list[list[bytes]]) -> None:
        wanted = set().union(*(words for _, words in waiting))
        new = wanted - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known = dict(self.of_special)
            new = wanted - self.known.keys()
        listed = list(new)
        self.known.update(zip(listed, self.vocabulary.encoded_words([w.encode() for w in listed])))
        for i, words in waiting:
            out[i].append(b"".join(map(self.known.__getitem__, words)))


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers in a binary column).

    Special strings in a text become their ids. A null or empty text has no tokens. Each row stands for itself, so repeated rows and
    ids give repeated rows, and an empty table an empty one. Only doc_id and text are read; nothing is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            ids = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its packed ids in a further column ``out``.

    Special ids give their strings, ids beyond the vocabulary nothing, bytes that are no UTF-8 a replacement sign; null ids give
    an empty text. A column of the name ``out`` must not exist.
    """
    if out in encoded.columns:
        raise ValueError(f"there is a column {out!r} already")
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = [*vocabulary.tokens, b""]
        for batch in batches:
            texts = []
            for packed in batch.column(at).to_pylist():
                known = np.minimum(np.frombuffer(packed or b"", "<u4"), len(tokens) - 1)
                texts.append(b"".join(map(tokens.__getitem__, known.tolist())).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, `{out}` string")


def op13_bpe_coding(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    vocabulary = load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    coded = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary), vocabulary)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
