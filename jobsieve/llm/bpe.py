"""Byte-level BPE by dynamic programming over prefixes.

Merging is never simulated on a text. For each prefix of a piece the table holds its last token: the one token that ends there and
agrees with the last token of the prefix before it. Two neighbours agree if merging would not have joined parts of both. Appending
bytes extends the table exactly, and an edit changes it only until old and new entries agree again."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve.llm.common import Remembered, per_worker, slices, texts

NEVER = 1 << 40
SHORT_SIZES = (3, 2, 1)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class Vocabulary:
    """Tokens with their ranks, which are also their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes = ranks, {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        #: How long tokens are that end in these four bytes, longest first; where no longer token does, those of three bytes at most may.
        sizes: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 3:
                sizes.setdefault(token[-4:], set()).add(len(token))
        self.sizes = {end: (*sorted(own, reverse=True), *(k for k in SHORT_SIZES if end[-k:] in ranks)) for end, own in sizes.items()}
        self._edges: dict[int, tuple | None] = {}
        #: first id << 32 | second id -> whether the two stay apart
        self.agree: dict[int, bool] = {}

    def edges(self, rank: int) -> tuple[list, list] | None:
        """The parts at the left and right edge while the token is merged from its bytes, each with the rank at which it becomes part
        of the next; None for a token that merging does not reach."""
        if rank not in self._edges:
            token = self.bytes[rank]
            parts, left, right = [token[i : i + 1] for i in range(len(token))], [], []
            whole = all(part in self.ranks for part in parts)
            while len(parts) > 1:
                least, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if least == NEVER:
                    break
                if at == 0:
                    left.append((parts[0], least))
                if at == len(parts) - 2:
                    right.append((parts[-1], least))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            whole = whole and len(parts) == 1
            self._edges[rank] = (left + [(token, NEVER)], right + [(token, NEVER)]) if whole else None
        return self._edges[rank]

    def stay_apart(self, first: int, second: int) -> bool:
        """Whether two tokens stay as they are when their bytes stand next to each other; first -1: whether merging makes the second."""
        if len(self.agree) > 600_000:
            self.agree.clear()
        after = self.edges(second)
        if first < 0 or after is None:
            known = after is not None
        else:
            known = self._edges_apart(self.edges(first)[1], after[0])
        self.agree[(first << 32) + second] = known
        return known

    def _edges_apart(self, rights: list, lefts: list) -> bool:
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = rights[i], lefts[j]
            rank = self.ranks.get(a + b, NEVER)
            # Of equal ranks the leftmost pair is merged first: a's own merge comes before, b's own after this one.
            if rank < a_until and rank <= b_until and rank < NEVER:
                return False
            if a_until == b_until == NEVER:
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1


class Prefixes:
    """The table of one piece: ``last[n]`` is the id of the last token of its first n bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self._extend(len(self.data))

    def become(self, data: bytes) -> None:
        """The table of ``data``; what it has in common with the bytes so far is kept."""
        n = min(len(data), len(self.data))
        # The first byte that differs is the highest that is not zero here.
        differs = int.from_bytes(data[:n]) ^ int.from_bytes(self.data[:n])
        n -= (differs.bit_length() + 7) >> 3
        del self.last[n + 1 :]
        self.data = data
        self._extend(len(data))

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Replaces bytes start to stop; returns how many entries behind ``start`` were made anew."""
        old_last, old_rest = self.last, self.data[stop:]
        self.data, self.last = self.data[:start] + data + old_rest, self.last[: start + 1]
        same, shift, made = 0, len(data) - (stop - start), 0
        while len(self.last) <= len(self.data):
            n = len(self.last)
            if same >= self.vocabulary.longest:  # all that later entries look at is as it was
                self.last += old_last[n - shift :]
                break
            self._extend(n)
            made += 1
            inside = n - shift > stop and len(self.vocabulary.bytes[self.last[n]]) <= n - start - len(data)
            same = same + 1 if inside and self.last[n] == old_last[n - shift] else 0
        return made

    def _extend(self, stop: int) -> None:
        """Entries for the prefixes of up to ``stop`` bytes."""
        v, data, last = self.vocabulary, self.data, self.last
        rank_of, known, sizes_of = v.ranks.get, v.agree.get, v.sizes.get
        for n in range(len(last), stop + 1):
            for size in sizes_of(data[n - 4 : n], SHORT_SIZES) if n > 3 else SHORT_SIZES[3 - n :]:
                if size <= n and (token := rank_of(data[n - size : n])) is not None:
                    before = last[n - size]
                    fits = known((before << 32) + token)
                    if fits or fits is None and v.stay_apart(before, token):
                        last.append(token)
                        break
            else:
                raise ValueError(f"no token for byte {data[n - 1]}")

    def tokens(self) -> list[int]:
        out, n, last, size = [], len(self.data), self.last, self.vocabulary.size
        while n:
            token = last[n]
            out.append(token)
            n -= size[token]
        out.reverse()
        return out


class Pieces(Remembered):
    """Pieces of text to their ids as little-endian int32 bytes."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(self.encoded)
        self.vocabulary = vocabulary

    def encoded(self, pieces: list[str]) -> list[bytes]:
        """Pieces come in the order of their bytes, so that neighbours share their first prefixes."""
        table, ranks, out = Prefixes(self.vocabulary), self.vocabulary.ranks.get, []
        for piece in pieces:
            data = piece.encode("utf-8", "surrogatepass")
            whole = ranks(data)
            if whole is None:
                table.become(data)
            out.append(whole.to_bytes(4, "little") if whole is not None else b"".join([t.to_bytes(4, "little") for t in table.tokens()]))
        return out


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary = Vocabulary(ranks)
        self.find, self.pieces = regex.compile(pattern).findall, Pieces(self.vocabulary)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(got), "<i4") for got in self.pieces.values_of([self.find(text) for text in texts])]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


def encoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = per_worker((path, pattern), lambda: Bpe(load_ranks(path), pattern))
        # Small parts: a window is left once a part does not fit any more.
        for part in slices(batches, 200, 1 << 20):
            found = bpe.encode(part.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, found)], dtype="i4")
            ids = pa.array(np.concatenate([*found, np.empty(0, "<i4")]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), ids)], ["doc_id", "token_ids"])

    return run


class Spelled:
    """The bytes of all tokens one after another, to look up many ids at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.begin, self.size = np.zeros(max(ranks.values()) + 1, np.int64), np.zeros(max(ranks.values()) + 1, np.int64)
        at = 0
        for token, rank in ranks.items():
            self.begin[rank], self.size[rank] = at, len(token)
            at += len(token)
        self.letters = np.frombuffer(b"".join(ranks), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, and where those of each id end."""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.begin[ids] - (ends - size), size)
        at += np.arange(len(at))
        return self.letters[at], ends


def decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = per_worker(path, lambda: Spelled(load_ranks(path)))
        for part in slices(batches, 400, 4 << 20):
            tokens = part.column(1)
            letters, ends = spelled.decode(tokens.flatten().to_numpy(zero_copy_only=False))
            ends = np.r_[0, ends][np.cumsum([0, *tokens.value_lengths().to_pylist()])]
            data, texts = letters.tobytes(), zip(ends.tolist(), ends[1:].tolist())
            yield pa.RecordBatch.from_arrays([part.column(0), tokens, pa.array([data[a:b] for a, b in texts], pa.binary())], ["doc_id", "token_ids", "decoded"])

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, token_ids array<int>.

    Each match of ``pattern`` is encoded on its own by the ranks in the file (token in base64 and rank per line); no special
    tokens; the pattern has no groups. Null and empty texts give no ids; null and repeated doc_ids keep their rows; other columns are not read. A text costs memory in proportion to its
    own length only."""
    return texts(docs).mapInArrow(encoder(ranks_path, pattern), "doc_id bigint, token_ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded``, the bytes of the ids; null ids count as none."""
    ids = F.coalesce("token_ids", F.array().cast("array<int>")).alias("token_ids")
    return encoded.select("doc_id", ids).mapInArrow(decoder(ranks_path), "doc_id bigint, token_ids array<int>, decoded binary")
