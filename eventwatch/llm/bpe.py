"""Byte-level BPE encoding and decoding by merge replay over a corpus.

The texts of a task are its corpus. Their distinct pieces (matches of the split pattern) are laid out once as a
linked list of byte tokens, with an inverted index from the rank of a token pair to the places of that pair. Merges
are then replayed in rank order over all pieces together: each rank's places are merged at once and only the two
neighbours of each place are looked at again, which may add places to the index. The result is the same as merging
every piece alone, lowest rank and leftmost first. Pieces already known in a task are neither replayed nor decoded again (a
table of bounded bytes). Encoding is a map over documents: no shuffle, and any lost task can run again. A replay over the distinct
pieces of the whole table would need every text's pieces shuffled twice, more than the texts themselves.

Defined cases: null and empty texts have no tokens; a piece that is a token as a whole is that token; texts of any
length work (pieces are found one by one, and the table of known pieces is bounded); decoding unknown ids raises.
"""

import base64
import heapq
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventwatch.llm.common import give_back, quoted, text_batches, text_of

KNOWN_BYTES = 5 << 20    # of pieces and their tokens that a task remembers, besides those of the batch at hand
TEXT_BATCH = 8 << 20     # characters whose new pieces are replayed together
_NONE = np.int64(1 << 40)


def load_ranks(path: str) -> bytes:
    """The rank file (lines of base64 token and rank)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


#: Letters, numbers and white space among the code points up to U+02AF, as members of a character class.
_LATIN = {r"\p{L}": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02af", r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe",
          r"\s": "\\t-\\r \x85\xa0"}
_NOT_LATIN = re.compile("[^\x00-\u02af]").search


def splitter(pattern: str):
    """A function that finds a text's pieces. Texts with code points up to U+02AF only take the standard library's
    engine, which is faster, on the same pattern with its classes written out."""
    full = regex.compile(pattern).findall
    latin = re.sub(r"\[[^\]]*\]", lambda m: re.sub(r"\\p\{[LN]\}|\\s", lambda c: _LATIN[c[0]], m[0]), pattern)
    latin = latin.replace(r"\S", f"[^{_LATIN[chr(92) + 's']}]")
    latin = re.sub(r"\\p\{[LN]\}|\\s", lambda c: f"[{_LATIN[c[0]]}]", latin)
    if re.search(r"\\[a-zA-Z]", latin.replace(r"\t-\r", "")):  # a class that is not listed here
        return full
    fast = re.compile(latin).findall
    return lambda text: full(text) if _NOT_LATIN(text) else fast(text)


class MergeReplay:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = splitter(pattern)
        self.text = {i: str(i) for i in ranks.values()}
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.base = max(ranks.values()) + 1
        pairs = [(ranks[t[:i]] * self.base + ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs.sort()
        self.pair = np.array([p for p, _ in pairs], np.int64)
        self.merged = np.array([r for _, r in pairs], np.int64)
        self.known: dict[str, tuple[str, tuple[int, ...], bytes]] = {}  # ids as text, ids, bytes that the ids decode to
        self.size = 0

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of what each pair merges into, or _NONE."""
        code = a * self.base + b
        at = np.searchsorted(self.pair, code)
        at[at == len(self.pair)] = 0
        return np.where(self.pair[at] == code, self.merged[at], _NONE) if len(self.pair) else np.full(len(code), _NONE)

    def replay(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The token ids of every piece, all pieces merged together."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(size.sum())
        first = np.cumsum(size) - size
        tok = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        # place n is a wall: it stands before the first and after the last token of every piece
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[(first + size - 1)[size > 0]] = n
        prv[first[size > 0]] = n
        nxt, prv, tok = np.r_[nxt, n], np.r_[prv, n], np.r_[tok, -1]
        rank = np.full(n + 1, _NONE)  # of the pair that starts at a place
        left = np.flatnonzero(nxt[:n] != n)
        rank[left] = self._rank(tok[left], tok[nxt[left]])
        index: dict[int, list[np.ndarray]] = {}
        todo: list[int] = []

        def note(places: np.ndarray) -> None:
            places = places[rank[places] != _NONE]
            if not len(places):
                return
            places = places[np.argsort(rank[places], kind="stable")]
            r = rank[places]
            cut = np.flatnonzero(r[1:] != r[:-1]) + 1
            for k, part in zip(r[np.r_[0, cut]].tolist(), np.split(places, cut)):
                if k in index:
                    index[k].append(part)
                else:
                    index[k] = [part]
                    heapq.heappush(todo, k)

        note(left)
        while todo:
            r = heapq.heappop(todo)
            parts = index.pop(r)
            at = np.sort(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
            at = at[(rank[at] == r) & np.r_[True, at[1:] != at[:-1]]]  # still this pair, and once
            at = self._leftmost(at, nxt)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            tok[at] = r
            nxt[at] = after
            prv[after] = at
            rank[gone] = _NONE
            prv[n] = n
            before = prv[at]
            places = np.concatenate([before[before != n], at])
            rank[places] = _NONE
            places = places[nxt[places] != n]
            rank[places] = self._rank(tok[places], tok[nxt[places]])
            note(places)
        alive = np.ones(n + 1, bool)
        alive[n] = False
        # a merged-away place is one that its predecessor skips
        inner = np.ones(n, bool)
        inner[first[size > 0]] = False
        places = np.flatnonzero(inner)
        alive[places] = nxt[prv[places]] == places
        ends = np.cumsum(alive[:n])
        ids = tok[:n][alive[:n]].tolist()
        stop = np.where(size > 0, ends[np.maximum(first + size - 1, 0)] if n else 0, 0).tolist()
        start = np.where(size > 0, ends[np.minimum(first, max(n - 1, 0))] - 1 if n else 0, 0).tolist()
        return [tuple(ids[a:b]) for a, b in zip(start, stop)]

    @staticmethod
    def _leftmost(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Of overlapping places (a run like aaaa) every second one, from the left."""
        if len(at) < 2:
            return at
        chained = nxt[at[:-1]] == at[1:]
        if not chained.any():
            return at
        new = np.flatnonzero(np.r_[True, ~chained])
        offset = np.arange(len(at)) - np.repeat(new, np.diff(np.r_[new, len(at)]))
        return at[offset % 2 == 0]

    def learn(self, pieces: set[str]) -> dict[str, tuple[str, tuple[int, ...], bytes]]:
        """Tokens of new pieces: their ids as decimal text and as numbers, and the bytes that the ids decode to."""
        raw = [p.encode() for p in pieces]
        whole = [self.ranks.get(b) for b in raw]
        some = self.replay([b for b, w in zip(raw, whole) if w is None])
        rest = iter(some)
        out = {}
        for p, w in zip(pieces, whole):
            ids = (w,) if w is not None else next(rest)
            out[p] = (" ".join(map(self.text.__getitem__, ids)), ids, self.decode(ids))
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[list[tuple[str, tuple[int, ...], bytes]]]:
        """For every text, the tokens of its pieces in order."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= TEXT_BATCH):
                size += len(texts[end])
                end += 1
            pieces = [self.split(t) for t in texts[at:end]]
            fresh = set(chain.from_iterable(pieces)).difference(self.known)
            if fresh:
                if self.size > KNOWN_BYTES:  # forget all but what this batch needs
                    self.known = {p: self.known[p] for p in set(chain.from_iterable(pieces)).difference(fresh)}
                    self.size = sum(map(len, self.known))
                self.known.update(self.learn(fresh))
                self.size += sum(map(len, fresh)) + 16 * len(fresh)
            for ps in pieces:
                yield list(map(self.known.__getitem__, ps))
            at = end

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(ids for tokens in self.encode_batch([text]) for _, ids, _ in tokens))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _shared(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(load_ranks(path))  # a vocabulary file: under 1 MB


def _portions(col: pa.Array, rows: int = 2000) -> Iterator[list[str]]:
    """The texts of a column, some at a time; null is empty."""
    for i in range(0, len(col), rows):
        yield [t or "" for t in col.slice(i, rows).to_pylist()]


def with_tokens(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """``df`` plus the token ids of its texts (array of int)."""
    data = _shared(df.sparkSession, ranks_path)

    @F.arrow_udf("array<int>")
    def encode(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        replay = MergeReplay(parse_ranks(data.value), pattern)
        for col in cols:
            got = chain.from_iterable(map(replay.encode_batch, _portions(col)))
            ids = [np.fromiter(chain.from_iterable(i for _, i, _ in tokens), np.int32) for tokens in got]
            yield pa.array(ids, pa.list_(pa.int32()))
        del replay
        give_back()
    return text_batches(df).withColumn(out, encode(text_of(text)))


def with_decoded(df: DataFrame, ranks_path: str, pattern: str, tokens: str = "tokens", out: str = "decoded") -> DataFrame:
    """``df`` plus the bytes that its token ids stand for (binary; null ids: empty)."""
    data = _shared(df.sparkSession, ranks_path)

    @F.arrow_udf("binary")
    def decode(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        replay = MergeReplay(parse_ranks(data.value), pattern)
        for col in cols:
            yield pa.array([replay.decode(ids or ()) for ids in col.to_pylist()], pa.binary())
    return text_batches(df).withColumn(out, decode(F.col(quoted(tokens))))


def with_token_digest(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "bpe") -> DataFrame:
    """``df`` plus a struct of digests of the round trip: n_tokens, ids_sha256 (decimal ids joined by one space),
    decoded_sha256 (the bytes that the ids decode to). The ids themselves never leave the task."""
    data = _shared(df.sparkSession, ranks_path)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        replay = MergeReplay(parse_ranks(data.value), pattern)
        for col in cols:
            n, a, b = [], [], []
            for tokens in chain.from_iterable(map(replay.encode_batch, _portions(col))):
                text_, ids, raw = zip(*tokens) if tokens else ((), (), ())
                n.append(sum(map(len, ids)))
                a.append(sha256(" ".join(text_).encode()).hexdigest())
                b.append(sha256(b"".join(raw)).hexdigest())  # decoded piece by piece, as the ids are
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             ["n_tokens", "ids_sha256", "decoded_sha256"])
        del replay
        give_back()
    return text_batches(df).withColumn(out, digest(text_of(text)))
