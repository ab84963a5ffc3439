"""Language-model scores from a sharded n-gram trie of Elias-Fano levels.

Probabilities of a token after one and after two others are interpolated with those of the next shorter context:
p(w | context) = (count(context w) + PRIOR * p(w | shorter)) / (count(context) + PRIOR), down to add-one probabilities of single tokens.

1. Texts become chunks of token numbers, a table in the warehouse bucketed by chunk, as what shards answer them is; later joins move neither texts nor answers.
2. Chunks send each different word once, with its count in the training texts, to the shard of its hash; the total and a short number of the word come back.
3. For each order a chunk sends its different n-grams, once each, in the order of their words' numbers and as differences, to the shard of the context. A context that occurs more than HOT times is
   spread over all shards by the next token as well, so no shard depends on how often a context occurs.
4. A shard writes the n-grams of the training texts as a trie level: contexts, pointers and successors in Elias-Fano form and the quantised share of
   the probability that comes from this order. It maps the file, and the queries search among the successors of their context."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsieve.llm.common import per_worker, slices

#: Weight of the shorter context, as a number of occurrences, for contexts of one and two tokens.
PRIOR = (30.0, 6.0)
HOT = 1 << 16
#: Steps of the quantised probabilities per power of ten; the last code stands for an n-gram that is not there.
STEPS, ABSENT = 4096, 65535
MIX = np.uint64(0x9E3779B97F4A7C15)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: What a chunk tells a shard about an n-gram: its context of one or two tokens, its last token, and the counts of both in the training texts, this chunk's and all.
SENT = {"first": np.uint64, "second": np.uint64, "token": np.uint64, "count": np.uint32, "total": np.float32}
#: Numbers of the begin and the end of a text in every chunk, and their hashes.
BEGIN, END = 0, 1
MARKS = np.array([1, 2], np.uint64)


ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)
#: ZERO_AT[b][k]: the place of the k-th zero of a byte, bits from the left.
ZERO_AT = np.array([[*[i for i in range(8) if not b >> (7 - i) & 1], *[8] * ONES[b]] for b in range(256)], np.int64)
#: Bytes of the high bits between two entries of the directory.
STRIDE = 4


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary (a one per value, a zero per step of the high part). It lies in a file and is searched in its
    packed form through the map of that file; a directory has the ones before every ``STRIDE`` bytes of the high bits."""

    def __init__(self, values: np.ndarray, file):
        values = values.astype(np.uint64)
        self.n = len(values)
        self.width = max(0, int(values[-1]).bit_length() - max(1, self.n).bit_length()) if self.n else 0
        octets, above = values.astype(">u8").view(np.uint8).reshape(-1, 8), 64 - self.width
        low = np.unpackbits(octets[:, above // 8 :], axis=1)[:, above % 8 :]
        high = (values >> np.uint64(self.width)).astype(np.int64) + np.arange(self.n)
        self.top = int(values[-1] >> np.uint64(self.width)) if self.n else 0
        unary = np.zeros((int(high[-1]) + 2 if self.n else 1), np.uint8)
        unary[high] = 1
        # Ten bytes behind the low bits let every value be read at once.
        low, unary = np.r_[np.packbits(low.ravel()), np.zeros(10, np.uint8)], np.packbits(unary)
        unary = np.r_[unary, np.zeros(-len(unary) % STRIDE, np.uint8)]
        self.directory = np.r_[0, np.cumsum(ONES[unary].reshape(-1, STRIDE).sum(1))].astype(np.uint32)
        self.at, self.sizes = file.tell(), (len(low), len(unary))
        file.write(low.tobytes())
        file.write(unary.tobytes())

    def _low(self, mapped: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The low bits of the values at ``i``."""
        if not self.width:
            return np.zeros(len(i), np.uint64)
        first = i.astype(np.int64) * self.width
        byte, shift = self.at + (first >> 3), (first & 7).astype(np.uint64)
        # Of up to nine bytes: eight, read at any place and shifted left, and what the ninth adds.
        x = np.ndarray((len(mapped) - 7,), ">u8", mapped, 0, (1,))[byte].astype(np.uint64)
        x = (x << shift) | (mapped[byte + 8].astype(np.uint64) >> (np.uint64(8) - shift))
        return x >> np.uint64(64 - self.width)

    def _select(self, mapped: np.ndarray, k: np.ndarray, zeros: bool) -> np.ndarray:
        """The place in the high bits of the k-th zero or one (from 0)."""
        base = self.at + self.sizes[0]
        ones = self.directory.astype(np.int64)
        before = np.arange(len(ones)) * (8 * STRIDE) - ones if zeros else ones
        block = np.searchsorted(before, k, "right") - 1
        left, at = k - before[block], block * STRIDE
        turned = np.uint8(0 if zeros else 255)
        byte = mapped[base + at] ^ turned
        for _ in range(STRIDE - 1):
            own = 8 - ONES[byte]
            on = left >= own
            left, at = np.where(on, left - own, left), at + on
            byte = mapped[base + at] ^ turned
        return at * 8 + ZERO_AT[byte, left]

    def get(self, mapped: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The values at ``i``."""
        high = self._select(mapped, i, False) - i
        return (high.astype(np.uint64) << np.uint64(self.width)) | self._low(mapped, i)

    def _search(self, mapped: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the first value of at least x among those with its high part, where these end, low bits) of each ``x``; both places are the length where the high
        part is beyond all.

        The high part of x names the values between two zeros; among them the low bits are searched by halving."""
        x = x.astype(np.uint64)
        high = np.minimum(x >> np.uint64(self.width), np.uint64(self.top + 1)).astype(np.int64)
        # The h-th zero ends the values with high part h; there are top + 1 of them at least.
        end = np.where(high > self.top, self.n, self._select(mapped, np.minimum(high, self.top), True) - np.minimum(high, self.top))
        first = np.where(high > 0, self._select(mapped, np.maximum(high - 1, 0), True) - np.maximum(high - 1, 0), 0)
        first[high > self.top] = self.n
        wanted, stop = x & np.uint64((1 << self.width) - 1), end.copy()
        at = np.flatnonzero(first < stop)
        while len(at):
            middle = (first[at] + stop[at]) >> 1
            less = self._low(mapped, middle) < wanted[at]
            first[at[less]], stop[at[~less]] = middle[less] + 1, middle[~less]
            at = at[first[at] < stop[at]]
        return first, end, wanted

    def next_at_least(self, mapped: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The place of the first value of at least ``x``; the length where there is none."""
        return self._search(mapped, x)[0]

    def place(self, mapped: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each ``x``."""
        at, end, wanted = self._search(mapped, x)
        inside = np.minimum(at, self.n - 1)
        # A place before the end has the high part of x.
        return inside, (at < end) & (self._low(mapped, inside) == wanted)

    def values(self, mapped: np.ndarray) -> np.ndarray:
        return self.get(mapped, np.arange(self.n)) if self.n else np.empty(0, np.uint64)


def ascending(values: np.ndarray) -> bool:
    return bool((values[1:] >= values[:-1]).all())


def changes(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in their order and the place of each value among them; what is in order already is not sorted."""
    if not ascending(values):
        return np.unique(values, return_inverse=True)
    new = changes(values)
    return values[new], np.cumsum(new) - 1


class Level:
    """The successors of every context in a shard, in a file of the task that ends with it."""

    def __init__(self, context: np.ndarray, token: np.ndarray, share: np.ndarray):
        """n-grams, each once, in any order, and their shares of the probability."""
        tokens, number = ranked(token)
        contexts, owner = ranked(context)
        counts = np.bincount(owner, minlength=len(contexts))
        self.span = max(1, len(tokens))
        successors = owner * self.span + number
        order = np.arange(len(owner)) if ascending(successors) else np.argsort(successors)
        self.file = tempfile.TemporaryFile()
        # Successors are relative to their context; adding its number times the vocabulary makes the level monotone.
        self.parts = [EliasFano(v, self.file) for v in (contexts, tokens, np.r_[0, np.cumsum(counts)], successors[order])]
        self.at = self.file.tell()
        self.file.write(quantised(share[order]).tobytes())
        self.file.flush()
        self.n = len(order)

    def find(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The code of each queried n-gram."""
        out = np.full(len(context), ABSENT, np.uint16)
        if not self.n:
            return out
        mapped = np.memmap(self.file, np.uint8, "r")
        contexts, tokens, pointers, successors = self.parts
        codes = mapped[self.at :].view(np.uint16)
        # Queries come by context: each context, and each token, is looked up once.
        own, which = ranked(context)
        i, known = contexts.place(mapped, own)
        begin, end = (pointers.get(mapped, i + k).astype(np.int64) for k in (0, 1))
        words, word = ranked(token)
        s, seen = tokens.place(mapped, words)
        at = np.flatnonzero(known[which] & seen[word])
        which, word = which[at], word[at]
        j, found = successors.place(mapped, i[which].astype(np.uint64) * np.uint64(self.span) + s[word].astype(np.uint64))
        # A successor must be one of its own context's.
        found &= (j >= begin[which]) & (j < end[which])
        out[at[found]] = codes[j[found]]
        return out

    def close(self) -> None:
        self.file.close()


def quantised(share: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(share) * STEPS), ABSENT - 1).astype(np.uint16)


def share_of_codes() -> np.ndarray:
    out = 10.0 ** (-np.arange(ABSENT + 1.0) / STEPS)
    out[ABSENT] = 0.0
    return out


def shares(codes: np.ndarray) -> np.ndarray:
    return per_worker("shares of the quantised codes", share_of_codes)[codes]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(32))) * MIX + b
    return (h ^ (h >> np.uint64(29))) * MIX


def compressor() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(values: np.ndarray) -> bytes:
    """Compressed by byte planes: the high bytes of small numbers cost next to nothing."""
    return per_worker("zstd", compressor)[0].compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(per_worker("zstd", compressor)[1].decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def restarted(steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at each start."""
    sums, at = np.cumsum(steps, dtype=np.uint64), np.flatnonzero(starts)
    return sums - np.repeat(sums[at] - steps[at], np.diff(np.r_[at, len(steps)]))


def relative(first: np.ndarray, second: np.ndarray, token: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """n-grams by their differences from the one before, which are small numbers where they are sorted; the first word begins anew at each start, the others also where
    what precedes them changes."""
    out = []
    for values in (first, second, token):
        out.append(np.where(starts, values, np.diff(values, prepend=np.uint64(0))))
        starts = starts | changes(values)
    return out


def absolute(first: np.ndarray, second: np.ndarray, token: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    out = []
    for steps in (first, second, token):
        out.append(restarted(steps, starts))
        starts = starts | changes(out[-1])
    return out


def starts_of(sizes: list[int]) -> np.ndarray:
    """Where parts of these sizes, none of them empty, begin."""
    out = np.zeros(sum(sizes), bool)
    out[np.r_[0, np.cumsum(sizes[:-1], dtype=np.int64)]] = True
    return out


def chunker(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 36
        for part in slices(batches, 2000, size):
            number, tokens, ends = defaultdict(count(2).__next__), [], []
            for text in part.column(1).to_pylist():
                tokens.extend(map(number.__getitem__, text.encode().translate(LOWER).split()))
                tokens.append(END)
                ends.append(len(tokens))
            words = np.append(MARKS, np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number)))
            row = serial, len(tokens), part.column(0).to_pylist(), part.column(2).to_pylist(), ends, words.tobytes(), np.array(tokens, np.uint32).tobytes()
            kinds = pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["chunk_id", "size", "doc_ids", "train", "ends", "words", "tokens"])
            serial += 1

    return run


class Chunk:
    """Token numbers of a chunk's texts and, as far as shards have answered, the statistics of their n-grams."""

    def __init__(self, row: dict, bits: int):
        self.bits, self.id, self.doc_ids = bits, row["chunk_id"], row["doc_ids"]
        self.words, self.tokens = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["tokens"], np.uint32).astype(np.int64)
        self.ends = np.array(row["ends"], np.int64)
        self.starts = np.r_[0, self.ends[:-1]]
        self.train = np.repeat(np.array(row["train"], bool), self.ends - self.starts)
        self.own = np.argsort(self.words, kind="stable")
        self.own = self.own[self.own != BEGIN]
        none = np.zeros(len(self.own), np.uint64)
        self.sent = [(self.words[self.own], none, none, np.bincount(self.tokens[self.train], minlength=len(self.words))[self.own], np.zeros(len(self.own)))]
        self.answers, self.shared = [], []
        for level in range(3):
            self.shared.append(self.parts(level))
            told = row.get(f"told{level}")
            if told is None:
                break
            self.hear(level, told)

    def parts(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(order, shard of each in that order) of what is sent on a level."""
        first, second, token, _, total = self.sent[level]
        context = mixed(first, second)
        key = np.where(total > HOT, mixed(context, token), context) * MIX
        shard = (key >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(key), np.int64)
        # Two bytes are sorted faster.
        order = np.argsort(shard.astype(np.uint16) if self.bits <= 16 else shard, kind="stable")
        return order, shard[order]

    def hear(self, level: int, told: list) -> None:
        order, shard = self.shared[level]
        kind = np.int64 if level == 0 else np.uint16
        heard, numbers = np.empty(len(order), kind), np.empty(len(order), np.uint64)
        for answer in told:
            a, b = np.searchsorted(shard, [answer["shard"], answer["shard"] + 1])
            heard[order[a:b]] = unpacked(answer["answer"], kind)
            if level == 0:
                numbers[order[a:b]] = unpacked(answer["numbers"], np.uint64)
        if level == 0:
            self.count, self.numbers = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.uint64)
            self.count[self.own], self.numbers[self.own] = heard, numbers
            # Every text begins once and ends once.
            self.begun = self.count[BEGIN] = self.count[END]
            # From here on words are in the order of their numbers, so that n-grams come sorted; the begin stays first.
            by = np.argsort(self.numbers, kind="stable")
            place = np.empty(len(by), np.int64)
            place[by] = np.arange(len(by))
            self.tokens, self.count, self.numbers = place[self.tokens], self.count[by], self.numbers[by]
            before = np.r_[BEGIN, self.tokens[:-1]]
            before[self.starts] = BEGIN
            self.total = [self.count[before].astype(np.float64)]
            context = self.numbers, np.zeros(len(self.numbers), np.uint64)
        else:
            self.answers.append(shares(heard)[self.which])
            if level == 2:
                return
            pairs = np.rint(shares(heard) * (self.pair_total + PRIOR[0]))
            n = len(pairs)
            before = np.r_[n, self.which[:-1]]
            before[self.starts] = n
            self.total.append(np.r_[pairs, self.begun][before])
            context = np.append(self.pair_context, np.uint64(0)), np.append(self.pair_token, np.uint64(0))
        key = before * len(self.words) + self.tokens
        # Any of equal n-grams stands for them: what is read at its place is the same for all.
        order = np.argsort(key)
        new = changes(key[order])
        first, self.which = order[new], np.empty(len(key), np.int64)
        self.which[order] = np.cumsum(new) - 1
        counts = np.bincount(self.which[self.train], minlength=len(first))
        own = tuple(c[before[first]] for c in context)
        self.pair_context, self.pair_token, self.pair_total = own[0], self.numbers[self.tokens[first]], self.total[level][first]
        # A context that is not hot meets all its n-grams in one shard, which can add them up itself.
        self.sent.append((*own, self.pair_token, counts, np.where(self.pair_total > HOT, self.pair_total, 0)))

    def scores(self, n: int, v: int) -> list[list]:
        single = (self.count + 1.0) / (n + v + 1.0)
        p = single[self.tokens]
        for prior, total, share in zip(PRIOR, self.total, self.answers):
            p = share + prior / (total + prior) * p
        sums = [np.add.reduceat(x, self.starts) for x in ((self.count > 0).astype(np.int64)[self.tokens], np.log10(single)[self.tokens], np.log10(p))] if len(self.starts) else [np.empty(0)] * 3
        return [self.doc_ids, (self.ends - self.starts).tolist(), *(s.tolist() for s in sums)]


def sender(level: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.slice(i, 1).to_pylist()[0], bits)
                order, shard = chunk.shared[level]
                cuts = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(order)]
                columns = [c[order].astype(k) for c, k in zip(chunk.sent[level], SENT.values())]
                columns[:3] = relative(*columns[:3], starts_of(np.diff(cuts).tolist()))
                split = [pa.array([packed(c[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[cuts[:-1]], pa.int64()), pa.array([chunk.id] * (len(cuts) - 1), pa.int64()), *split],
                    ["shard", "chunk_id", *SENT],
                )

    return run


def received(table: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    parts = [[unpacked(b, kind) for b in table.column(name).to_pylist()] for name, kind in SENT.items()]
    sizes, columns = [len(c) for c in parts[0]], [np.concatenate(c) for c in parts]
    columns[:3] = absolute(*columns[:3], starts_of(sizes))
    return sizes, columns


def answered(table: pa.Table, sizes: list[int], values: np.ndarray, numbers: np.ndarray | None = None, n: int = 0, v: int = 0) -> pa.Table:
    answers, told = ([packed(part) for part in np.split(x, np.cumsum(sizes)[:-1])] if x is not None else [None] * len(sizes) for x in (values, numbers))
    first = [1] + [0] * (len(sizes) - 1)
    return pa.table(
        [table.column("chunk_id"), table.column("shard"), pa.array(answers, pa.binary()), pa.array(told, pa.binary()), pa.array([n * f for f in first], pa.int64()), pa.array([v * f for f in first], pa.int64())],
        ["chunk_id", "shard", "answer", "numbers", "n", "v"],
    )


def count_words(bits: int):
    def run(table: pa.Table) -> pa.Table:
        sizes, (word, _, _, count, _) = received(table)
        distinct, which = np.unique(word, return_inverse=True)
        totals = np.bincount(which, count, len(distinct)).astype(np.int64)
        # Shards number their words independently, frequent ones first, so that most of what is sent are small numbers; 0 is the begin of a text.
        rank = np.empty(len(distinct), np.uint64)
        rank[np.argsort(-totals, kind="stable")] = np.arange(len(distinct), dtype=np.uint64)
        numbers = (rank << np.uint64(bits)) + np.uint64(table.column("shard")[0].as_py() + 1)
        return answered(table, sizes, totals[which], numbers[which], int(totals.sum()), int(np.count_nonzero(totals)))

    return run


def answer_level(prior: float):
    def run(table: pa.Table) -> pa.Table:
        sizes, (first, second, token, count, total) = received(table)
        context = mixed(first, second)
        owner, (tokens, number) = ranked(context)[1], ranked(token)
        key = owner * len(tokens) + number
        order = np.argsort(key)
        new = changes(key[order])
        first = np.flatnonzero(new)
        counts = np.add.reduceat(count[order].astype(np.int64), first)
        distinct = order[first]
        begin = changes(owner[distinct])
        sums = np.add.reduceat(counts, np.flatnonzero(begin))[np.cumsum(begin) - 1]
        known = np.maximum(np.where(total[distinct] > 0, total[distinct].astype(np.float64), sums), counts)
        seen = counts > 0
        own = distinct[seen]
        level = Level(context[own], token[own], counts[seen] / (known[seen] + prior))
        codes = level.find(context[distinct], token[distinct])
        level.close()
        out = np.empty(len(order), np.uint16)
        out[order] = codes[np.cumsum(new) - 1]
        return answered(table, sizes, out)

    return run


def shard_bits(tokens: int, shard_tokens: int) -> int:
    """The nearest power of two: what is sent and answered per chunk and shard grows with the shards, so there are no more than needed."""
    return max(0, round(math.log2(max(1, tokens / shard_tokens))))


def scorer(bits: int, n: int, v: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()
        for batch in batches:
            for i in range(batch.num_rows):
                columns = Chunk(batch.slice(i, 1).to_pylist()[0], bits).scores(n, v)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def scored(docs: DataFrame, train: Column, chunk_bytes: int = 6 << 20, shard_tokens: int = 1 << 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score (log10), by a model of the rows where ``train`` holds.

    Null text counts as empty: its one token is the end. A null ``train`` does not count as training; null and repeated doc_ids keep their rows; without any training rows all
    tokens are equally likely; an empty table gives no rows. Other columns are not read, except by ``train``."""
    spark = docs.sparkSession
    name, buckets = f"tokens_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").bucketBy(buckets, "chunk_id").saveAsTable(name)
        return spark.table(name)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    rows = rows.mapInArrow(chunker(chunk_bytes), "chunk_id bigint, size bigint, doc_ids array<bigint>, train array<boolean>, ends array<bigint>, words binary, tokens binary")
    chunks = dealt(rows, name)
    size = chunks.agg(F.sum("size")).first()[0] or 0
    bits = shard_bits(size, shard_tokens)
    n = v = 0
    for level in range(3):
        sent = chunks.mapInArrow(sender(level, bits), "shard bigint, chunk_id bigint, " + ", ".join(f"{column} binary" for column in SENT))
        answer = count_words(bits) if level == 0 else answer_level(PRIOR[level - 1])
        told = sent.groupBy("shard").applyInArrow(answer, "chunk_id bigint, shard bigint, answer binary, numbers binary, n bigint, v bigint")
        # Answers go to their chunks once; later passes find them in the buckets.
        own = F.collect_list(F.struct("shard", "answer", "numbers")).alias(f"told{level}")
        told = dealt(told.groupBy("chunk_id").agg(own, F.sum("n").alias("n"), F.sum("v").alias("v")), f"{name}_{level}")
        if level == 0:
            n, v = (x or 0 for x in told.agg(F.sum("n"), F.sum("v")).first())
        chunks = chunks.join(told.select("chunk_id", f"told{level}"), "chunk_id")
    out = chunks.mapInArrow(scorer(bits, n, v), "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(n).cast("bigint"))
