"""Scores of texts under a probabilistic suffix tree, beside an add-one unigram model.

A text is its words, A-Z in lower case, and one end. Every word of the training texts is a symbol of
the tree, however rare; all words that they lack are one more. Contexts are the last symbols, up to `DEPTH`.
Every context that occurs twice is counted with all its next symbols, and is retained if its
next-symbol distribution diverges from that of its suffix (count times Kullback-Leibler divergence above
`DIVERGENCE`). Distributions are smoothed towards that of the next shorter context, in the end towards
add-one frequencies. A symbol is scored by its longest retained context. So the probabilities of all
symbols sum to one, over the same events as in the unigram model.

Texts are dealt into chunks. A chunk numbers its words itself: common words (`COMMON_SHARE` of the
tokens, so their number is bounded) alike everywhere, the others as they come. Of these it sends each once
to the bucket that the word hashes to, with its training counts, alone and after hot symbols, and gets
back the word's number in the corpus and its counts over all chunks. No table of all words is in one place.

The tree grows with the corpus and is never in one place either. A chunk sends its distinct (context, next
symbol) with their training counts to the part of the tree that holds the context, by the symbol before
the next one, and gets the log probabilities back. A part counts, tests and scores all contexts
that end in its symbols. Symbols with `HOT_SHARE` of all positions, whose number is bounded, are dealt over
several parts by the symbol before; their own counts come from the buckets and, before common words, by a
broadcast, and the sums over all their next symbols by another. A symbol that occurs less than twice is in no
context that is retained, so nothing is asked about what follows it.

What is broadcast is bounded by the shares, and by the pairs of a hot symbol and a common word.

Defined results: a null or empty text is the end alone; without training texts N and V are 0 and
all scores are 0; very long texts are scored whole, each by itself; equal rows give equal results and
are kept apart; an empty table gives no rows; columns other than doc_id and text are not read.
The log probability of a symbol is rounded to single precision before those of a text are summed.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.llm.common import fold, slices
from liftlens.llm.shingles import mixed
from liftlens.operators.scale import cut_lineage

FOLDS, HELD_OUT = 7, 2
DEPTH = 2
COMMON_SHARE = 1 / 20_000
HOT_SHARE = 1 / 512
LEAST = 2  # occurrences of a context
DIVERGENCE = 10.0
STRENGTH = 4.0  # of the shorter context in the smoothing
TEXT_END = b"\n"  # no word holds white space
FLUSH = 1 << 18  # distinct words counted in a task before they are handed on
BYTES = 1 << 19  # bytes of text that are worked on together
CHUNK = 1 << 19  # tokens of a chunk, or one longer text
PART = 1 << 20  # positions in a part of the tree
BUCKET = 1 << 20  # rare words in a bucket, each once for a chunk that holds it
CHUNK_BITS = 32  # of a chunk's number: its place in the task
START, OTHER = 0, 1  # symbols: before a text, and words that the training texts lack


def tokens(text: str | None) -> list[bytes]:
    return [*(text.encode().lower().split() if text else ()), TEXT_END]


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def joined(words: list[bytes]) -> tuple[bytes, int]:
    """Words without line breaks, packed, and what that was from."""
    text = b"\n".join(words)
    return pa.compress(text, "zstd", asbytes=True), len(text)


def apart(packed: bytes, size: int, n: int) -> list[bytes]:
    """The `n` words that were joined."""
    return pa.decompress(packed, size, "zstd", asbytes=True).split(b"\n") if n else []


def met(messages: pa.Table) -> pa.ChunkedArray:
    """The words of all messages, coded."""
    columns = (messages.column(c).to_pylist() for c in ("words", "words_size", "size"))
    return pa.array(list(itertools.chain.from_iterable(map(apart, *columns))), pa.binary()).dictionary_encode()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over the training documents; summed inside each task first, sent packed by ranges of
    their hashes."""
    buckets = max(4 * docs.sparkSession.sparkContext.defaultParallelism, docs.rdd.getNumPartitions())

    def run(batches):
        seen: Counter = Counter()

        def out():
            words, n = list(seen), np.fromiter(seen.values(), np.int64, len(seen))
            bucket = buckets_of(hashes(words), buckets)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
            words = [b"" if words[i] == TEXT_END else words[i] for i in order]
            texts, sizes = zip(*(joined(words[i:j]) for i, j in zip([0, *ends], ends)))
            return pa.RecordBatch.from_arrays([
                pa.array(bucket[ends - 1]), pa.array(np.diff(ends, prepend=0)), pa.array(texts, pa.binary()),
                pa.array(sizes), runs(n[order], ends)], names=["bucket", "size", "words", "words_size", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(tokens(text))
                if len(seen) > FLUSH:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    def add(messages: pa.Table) -> pa.Table:
        coded = met(messages)
        n = np.concatenate([wide(x, k) for x, k in zip(*(messages.column(c).to_pylist() for c in ("n", "size")))])
        words = pc.replace_with_mask(coded.dictionary, pc.equal(coded.dictionary, b""), pa.scalar(TEXT_END))
        return pa.table([words, pa.array(np.bincount(coded.indices.to_numpy(), n).astype(np.int64))], names=["word", "n"])

    training = docs.where(fold("doc_id", FOLDS) != HELD_OUT).select("text")
    parts = training.mapInArrow(run, "bucket long, size long, words binary, words_size long, n binary")
    return parts.groupBy("bucket").applyInArrow(add, "word binary, n long")


class Symbols:
    """The numbers and counts of the common words, and how many tokens and symbols there are."""

    def __init__(self, common: list[tuple[bytes, int]], total: int, kinds: int):
        ranked = sorted(common, key=lambda x: (-x[1], x[0]))  # small numbers pack better
        self.common = {w: i for i, (w, _) in enumerate(ranked, OTHER + 1)}
        self.first = OTHER + 1 + len(ranked)  # of the numbers of rarer words
        self.frequency = np.array([0, 0, *(n for _, n in ranked)], float)
        self.total, self.size = total, kinds + 1  # START follows nothing

    def __call__(self, word: bytes) -> int:
        return self.common.get(word, OTHER)


def symbols_of(counts: DataFrame, total: int | None = None) -> Symbols:
    """From word, n of the training texts; the rarer words are only summed up where they are counted."""

    def run(batches):
        parts = [(b.column(0), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            words, n = pa.chunked_array([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
            kept = (n >= COMMON_SHARE * n.sum()) | pc.equal(words, pa.scalar(TEXT_END, words.type)).to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.array([None, *words.filter(pa.array(kept)).to_pylist()], pa.binary()),
                pa.array([n[~kept].sum(), *n[kept]], pa.int64()),
                pa.array([(~kept).sum(), *np.ones(kept.sum())], pa.int64())], names=["word", "n", "kinds"])

    some = cut_lineage(counts.mapInArrow(run, "word binary, n long, kinds long"))
    found, kinds = some.agg(F.sum("n"), F.sum("kinds")).first()
    total = total or found or 0
    least = max(1, math.ceil(total * COMMON_SHARE))
    sent = some.where((F.col("n") >= least) | (F.col("word") == F.lit(bytearray(TEXT_END)))).where(
        "word IS NOT NULL").toArrow()
    return Symbols(list(zip(sent.column("word").to_pylist(), sent.column("n").to_pylist())), total, kinds or 0)


class Numbers(dict):
    """Numbers of words: those given, and for others the next ones as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = OTHER + 1 + len(self)
        return number


def placed(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted stand among sorted keys, and whether they do."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """Retained contexts by depth. A context's key is that of its suffix's place, and one more
    symbol: contexts of depth d are (symbol d back) over a context of depth d - 1."""

    def __init__(self, frequencies: np.ndarray, total: float | None = None, size: int | None = None):
        """`total`, `size`: tokens and symbols of the corpus, if more than those given."""
        self.size = len(frequencies)
        self.root = np.log10((frequencies + 1) / (
            (frequencies.sum() if total is None else total) + (size or self.size)))
        self.levels = []  # per depth: keys, log10 of what is left, keys and log10 of next symbols

    def contexts(self, history: np.ndarray, depth: int, order: np.ndarray):
        """Numbers of the contexts of `depth` symbols (back from each position), if retained.
        `history`: column i is the symbol i + 1 back."""
        at, alive = np.zeros(len(history), np.int64), np.ones(len(history), bool)
        for d in range(depth):
            found, known = placed(self.levels[d][0], at * self.size + history[:, d])
            at, alive = found, alive & known
        return at, alive

    def logs(self, history: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after its history, by its longest retained suffix."""
        out = self.root[symbol]
        at, alive = np.zeros(len(symbol), np.int64), np.ones(len(symbol), bool)
        for d, (keys, left, next_keys, next_logs) in enumerate(self.levels):
            at, known = placed(keys, at * self.size + history[:, d])
            alive = alive & known
            place, seen = placed(next_keys, at * self.size + symbol)
            out = np.where(alive, np.where(seen, next_logs[place] if len(next_logs) else 0.0,
                                           left[at] + out if len(left) else out), out)
        return out

    def add_level(self, context: np.ndarray, total: np.ndarray, of: np.ndarray,
                  symbol: np.ndarray, n: np.ndarray, history: np.ndarray,
                  whole: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        """Test the contexts (sorted keys, and their totals) by their next symbols: `of` is the
        context's place, `history` what precedes the symbol. `whole`: which contexts have next symbols
        elsewhere, too, and the sums over all of these that `parts_of` gives for one."""
        below = 10 ** self.logs(history, symbol)
        chance, *terms = parts_of(n, total[of], below)
        sums = np.array([np.bincount(of, x, len(context)) for x in (chance, *terms)])
        unseen = np.maximum(total - np.bincount(of, n, len(context)), 0)
        if whole is not None:
            sums, unseen = np.where(whole[0], whole[1], sums), np.where(whole[0], 0, unseen)
        rest, rest_below = np.maximum(1 - sums[0], 1e-9), np.maximum(1 - sums[1], 1e-9)
        gain = sums[2] + unseen * np.log(rest / rest_below)
        keep = gain > DIVERGENCE
        number = np.cumsum(keep) - 1
        kept = keep[of]
        keys = number[of[kept]] * self.size + symbol[kept]
        order = np.argsort(keys)
        self.levels.append((context[keep], np.log10(rest / rest_below)[keep],
                            keys[order], np.log10(chance[kept])[order]))


def parts_of(n: np.ndarray, total: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of next symbols that occur `n` times in `total`: their chance, that in the shorter context,
    and what they add to the divergence."""
    chance = (n + STRENGTH * below) / (total + STRENGTH)
    return chance, below, n * np.log(chance / below)


def coded(docs: DataFrame, symbols) -> DataFrame:
    """A row per chunk: its number; of its texts, in lists, what is returned, the tokens, and what is
    known of their scores before the tree is asked, 0; its other than common words in order of their hashes;
    and the numbers of all words, from `first` on by place among these."""

    def run(batches):
        own = symbols.value
        task, chunk = TaskContext.get().partitionId(), 0
        number_of, held, size = Numbers(own.common), [], 0

        def out():
            ids, folds, lengths, numbers = (list(itertools.chain.from_iterable(x)) for x in zip(*held))
            words = list(itertools.islice(number_of, len(own.common), None))
            order = np.argsort(hashes(words), kind="stable")
            words = [words[i] for i in order]
            number = np.arange(own.first + len(words))
            number[own.first + order] = own.first + np.arange(len(words))
            lists, (text, text_size) = [ids, folds, lengths, [0.0] * len(ids)], joined(words)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << CHUNK_BITS) + chunk]),
                 *(pa.array([x], pa.list_(k)) for x, k in zip(lists, KINDS)),
                 pa.array([len(words)]), pa.array([text]), pa.array([text_size]),
                 pa.array([narrow(number[np.concatenate(numbers)])])], names=CODED)

        for batch in slices(batches, 2, BYTES):
            ids, folds, column = batch.columns
            lists = [tokens(t) for t in column.to_pylist()]
            lengths = list(map(len, lists))
            s = np.fromiter(map(number_of.__getitem__, itertools.chain.from_iterable(lists)),
                            np.int64, sum(lengths))
            held.append((ids.to_pylist(), folds.to_pylist(), lengths, [s]))
            size += len(s)
            if size >= CHUNK:
                yield out()
                number_of, held, size, chunk = Numbers(own.common), [], 0, chunk + 1
        if held:
            yield out()

    rows = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(run, "chunk long, doc_id array<long>, held_out array<boolean>, "
                                "n_tokens array<long>, score array<double>, n_words long, words binary, "
                                "words_size long, symbols binary")


KINDS = (pa.int64(), pa.bool_(), pa.int64(), pa.float64())
CODED = ["chunk", "doc_id", "held_out", "n_tokens", "score", "n_words", "words", "words_size", "symbols"]


class Deal:
    """The part of the tree that holds a context: by its last symbol, and those of hot symbols
    also by the one before; and how often each common symbol is a context."""

    def __init__(self, symbols: Symbols, starts: int, parts: int, buckets: int = 1):
        self.first, self.frequency = symbols.first, symbols.frequency
        self.total, self.size = symbols.total, symbols.size
        self.context = symbols.frequency.copy()
        self.context[START] = starts
        total = max(self.context.sum(), self.total, 1.0)
        self.parts, self.buckets = parts, buckets
        self.hot = self.context > total * HOT_SHARE
        self.over = np.where(self.hot, np.ceil(self.context / total * parts), 1).astype(np.uint64)

    def of_common(self, values: np.ndarray, numbers: np.ndarray, other) -> np.ndarray:
        """What the common symbols among the numbers have, and `other` for the rest."""
        return np.where(numbers < self.first, values[np.minimum(numbers, self.first - 1)], other)

    def part(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        parts = np.uint64(self.parts)
        spread = mixed(b.astype(np.uint64)) % self.of_common(self.over, a, np.uint64(1))
        return ((mixed(a.astype(np.uint64)) % parts + spread) % parts).astype(np.int64)

    def root(self, n: np.ndarray) -> np.ndarray:
        """The probability of a symbol that occurs n times."""
        return (n + 1) / (self.total + self.size)


def positions(symbols: bytes, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each position in a chunk the symbol, the one before and the one before that."""
    flat = wide(symbols, sum(lengths))
    begins = np.cumsum(lengths) - lengths
    a, b = (np.concatenate([np.full(i, START), flat[:-i]])[:len(flat)] for i in (1, 2))
    a[begins] = b[begins] = START
    second = begins[np.array(lengths) > 1] + 1
    b[second] = START
    return flat, a, b


def distinct(a: np.ndarray, b: np.ndarray, s: np.ndarray, size: int):
    """The distinct triples of numbers below `size`, in order, and which of them each is."""
    if size ** 3 < 1 << 62:
        keys, which = np.unique((a * size + b) * size + s, return_inverse=True)
        context = keys // size
    else:
        contexts, at = np.unique(a * size + b, return_inverse=True)
        keys, which = np.unique(at * size + s, return_inverse=True)
        context = contexts[keys // size]
    return context // size, context % size, keys % size, which


def squeezed(values: np.ndarray) -> bytes:
    """The values, packed by their first bytes, second bytes and so on."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return b"".join(len(x).to_bytes(4, "little") + x for x in (
        pa.compress(np.ascontiguousarray(p).tobytes(), "zstd", asbytes=True) for p in planes))


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, packed in as few bytes as the largest needs."""
    return squeezed(values.astype(np.min_scalar_type(int(values.max(initial=0)))))


def loose(packed: bytes, n: int, kind=None) -> np.ndarray:
    """The `n` values that were packed."""
    planes, at = [], 0
    while at < len(packed):
        end = at + 4 + int.from_bytes(packed[at:at + 4], "little")
        planes.append(np.frombuffer(pa.decompress(packed[at + 4:end], n, "zstd"), np.uint8))
        at = end
    if not planes:
        return np.empty(0, kind or np.uint8)
    return np.stack(planes, axis=1).reshape(-1).view(kind or f"u{len(planes)}")


def wide(packed: bytes, n: int) -> np.ndarray:
    """The whole numbers that `narrow` has packed."""
    return loose(packed, n).astype(np.int64)


def runs(values: np.ndarray, ends: np.ndarray, pack=narrow) -> pa.Array:
    """The runs of the values up to each of the ends, packed."""
    return pa.array([pack(x) for x in np.split(values, ends[:-1])], pa.binary())


def folded(values: np.ndarray) -> np.ndarray:
    """Numbers of any sign as numbers from 0 on, small ones as small ones."""
    return np.where(values < 0, -2 * values - 1, 2 * values)


def unfolded(values: np.ndarray) -> np.ndarray:
    return np.where(values % 2, -(values + 1) // 2, values // 2)


class Pairs:
    """The distinct pairs of a hot symbol and a rare word after it in a chunk: place of the word, symbol."""

    def __init__(self, deal: Deal, symbols: bytes, lengths: list[int]):
        self.symbols, before, _ = positions(symbols, lengths)
        self.rare = self.symbols >= deal.first
        self.use = self.rare & deal.of_common(deal.hot, before, False)
        keys = (self.symbols[self.use] - deal.first) * deal.first + before[self.use]
        self.keys, self.which = np.unique(keys, return_inverse=True)
        self.place, self.hot = self.keys // deal.first, self.keys % deal.first


def mentioned(chunks: DataFrame, deal) -> DataFrame:
    """Per chunk and bucket the rare words, their training counts, and those after hot symbols."""

    def run(batches):
        own = deal.value
        for batch in batches:
            for chunk, held, lengths, n_words, packed_words, size, symbols in zip(
                    *(c.to_pylist() for c in batch.columns)):
                words = apart(packed_words, size, n_words)
                bucket = buckets_of(hashes(words), own.buckets)
                pairs, trained = Pairs(own, symbols, lengths), np.repeat(~np.array(held), lengths)
                n = np.bincount(pairs.symbols[trained & pairs.rare] - own.first, minlength=n_words)
                m = np.bincount(pairs.which, trained[pairs.use], len(pairs.keys)).astype(np.int64)
                # a chunk without such words asks for none, so that it gets an answer
                ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, n_words)
                begins = np.append(0, ends[:-1])
                cuts = np.searchsorted(pairs.place, ends)
                many = np.diff(cuts, prepend=0)
                texts, sizes = zip(*(joined(words[i:j]) for i, j in zip(begins, ends)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[begins] if n_words else np.zeros(1, np.int64)),
                    pa.array(np.full(len(ends), chunk)), pa.array(ends - begins),
                    pa.array(texts, pa.binary()), pa.array(sizes), runs(n, ends), pa.array(many),
                    runs(pairs.place - np.repeat(begins, many), cuts), runs(pairs.hot, cuts), runs(m, cuts)],
                    names=MENTIONED)

    return chunks.select("chunk", "held_out", "n_tokens", "n_words", "words", "words_size", "symbols").mapInArrow(
        run, "bucket long, chunk long, size long, words binary, words_size long, n binary, pairs long, "
             "place binary, hot binary, m binary")


MENTIONED = ["bucket", "chunk", "size", "words", "words_size", "n", "pairs", "place", "hot", "m"]


def numbered(mentions: DataFrame, deal) -> DataFrame:
    """Per chunk and bucket, in the order of the words and pairs that were sent: the words' numbers, within
    a bucket in order of their counts, as small numbers pack better, then of the words, their counts and those of the pairs; and, once for a
    bucket, the sums of `parts_of` for each hot symbol."""

    def run(messages: pa.Table) -> pa.Table:
        own = deal.value
        bucket = messages.column("bucket")[0].as_py()
        column = lambda c: messages.column(c).to_pylist()
        sizes, pairs = (messages.column(c).to_numpy() for c in ("size", "pairs"))
        unpacked = lambda c, many: np.concatenate(
            [wide(x, k) for x, k in zip(column(c), many)])
        coded = met(messages)
        index, kinds = coded.indices.to_numpy(), len(coded.dictionary)
        counts = np.bincount(index, unpacked("n", sizes), kinds).astype(np.int64)
        order = pc.sort_indices(pa.table([pa.array(-counts), coded.dictionary], names=["n", "word"]), sort_keys=[
            ("n", "ascending"), ("word", "ascending")]).to_numpy()
        ranks = np.empty(kinds, np.int64)
        ranks[order] = np.arange(kinds)
        index, counts = ranks[index], counts[order]
        place = unpacked("place", pairs) + np.repeat(np.cumsum(sizes) - sizes, pairs)
        keys, which = np.unique(index[place] * own.first + unpacked("hot", pairs), return_inverse=True)
        m = np.bincount(which, unpacked("m", pairs), len(keys)).astype(np.int64)
        seen = m > 0
        word, hot = keys[seen] // own.first, keys[seen] % own.first
        terms = parts_of(m[seen], own.context[hot], own.root(counts[word]))
        sums = np.array([np.bincount(hot, x, own.first) for x in terms])[:, own.hot]
        ends, cuts = np.cumsum(sizes), np.cumsum(pairs)
        return pa.table([
            messages.column("chunk"), messages.column("bucket"), messages.column("size"),
            messages.column("pairs"), runs(own.first + index * own.buckets + bucket, ends),
            runs(counts[index], ends), runs(m[which], cuts),
            pa.array([sums.tobytes()] + [b""] * (len(sizes) - 1), pa.binary())],
            names=["chunk", "bucket", "size", "pairs", "number", "n", "m", "sums"])

    return mentions.groupBy("bucket").applyInArrow(
        run, "chunk long, bucket long, size long, pairs long, number binary, n binary, m binary, sums binary")


def named(chunks: DataFrame, answers: DataFrame, deal) -> DataFrame:
    """The chunks, with their rare words in order of their numbers in the corpus; these numbers, by
    their steps, and counts; the pairs of such a word after a hot symbol that occur; and the sums of
    `parts_of` that came along."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        own, out = deal.value, []
        for chunk, ids, held, lengths, n_words, symbols in zip(*(c.to_pylist() for c in texts.columns)):
            asked = Pairs(own, symbols, lengths)
            got = sorted(zip(*(answers.column(c).to_pylist() for c in NUMBERED)))
            number, n, m = (np.concatenate([wide(x[i], x[k]) for x in got]) for i, k in ((3, 1), (4, 1), (5, 2)))
            seen = np.flatnonzero(n)
            seen = seen[np.argsort(number[seen])]
            code = np.full(n_words, OTHER)
            code[seen] = own.first + np.arange(len(seen))
            s = asked.symbols
            s[asked.rare] = code[s[asked.rare] - own.first]
            kept = np.flatnonzero(m)
            pairs = (code[asked.place] - own.first) * own.first + asked.hot
            kept = kept[np.argsort(pairs[kept])]
            sums = [np.frombuffer(x[6]).reshape(3, -1) for x in got if x[6]]
            out.append((chunk, ids, held, lengths, narrow(s), len(seen), narrow(np.diff(number[seen], prepend=0)),
                        narrow(n[seen]), len(kept), narrow(np.diff(pairs[kept], prepend=0)), narrow(m[kept]),
                        sum(sums).tobytes() if sums else b""))
        return pa.table([pa.array(x, k) for x, k in zip(zip(*out), NAMED.values())], names=list(NAMED))

    return chunks.select("chunk", "doc_id", "held_out", "n_tokens", "n_words", "symbols").groupBy(
        "chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, "chunk long, doc_id array<long>, held_out array<boolean>, n_tokens array<long>, symbols binary, "
                                                    "n_words long, numbers binary, n binary, "
                                                    "pairs long, pair binary, m binary, sums binary")


NUMBERED = ["bucket", "size", "pairs", "number", "n", "m", "sums"]
NAMED = {"chunk": pa.int64(), "doc_id": pa.list_(pa.int64()), "held_out": pa.list_(pa.bool_()),
         "n_tokens": pa.list_(pa.int64()), "symbols": pa.binary(), "n_words": pa.int64(),
         "numbers": pa.binary(), "n": pa.binary(), "pairs": pa.int64(), "pair": pa.binary(),
         "m": pa.binary(), "sums": pa.binary()}
ASKING = ["n_tokens", "symbols", "n_words", "numbers", "n"]


class Chunk:
    """What a named chunk wants to know: the distinct (symbol before, that before it, symbol) after
    contexts that occur twice, by part and in order, and which of them its positions have."""

    def __init__(self, deal: Deal, lengths, symbols, n_words, numbers, n):
        self.symbols, a, b = positions(symbols, lengths)
        self.n = np.concatenate([deal.frequency, wide(n, n_words)])  # by number in the chunk
        number = np.concatenate([np.arange(deal.first), np.cumsum(wide(numbers, n_words))])
        context = np.concatenate([deal.context, self.n[deal.first:]])
        self.live = context[a] >= LEAST
        b = np.where(context[b] >= LEAST, b, OTHER)
        a, b, s, which = distinct(a[self.live], b[self.live], self.symbols[self.live], len(number))
        part = deal.part(number[a], number[b])
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.which, self.part = place[which], part[order]
        a, b, s = a[order], b[order], s[order]
        self.a, self.b, self.s = number[a], number[b], number[s]
        self.in_chunk, self.before, self.rare = s, a, s >= deal.first

    def paired(self, deal: Deal, pairs: int, pair: bytes, m: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys have a rare word after a hot symbol, and how often that occurs."""
        use = self.rare & deal.of_common(deal.hot, self.before, False)
        at, known = placed(np.cumsum(wide(pair, pairs)),
                           (self.in_chunk[use] - deal.first) * deal.first + self.before[use])
        return use, np.where(known, wide(m, pairs)[at] if pairs else 0, 0)


def asked(chunks: DataFrame, deal) -> DataFrame:
    """Per chunk and part the distinct (one before, two before, symbol) and their training counts;
    of rare symbols also the counts, alone and after hot ones."""

    def run(batches):
        for batch in batches:
            for chunk, held, *row, pairs, pair, m in zip(*(c.to_pylist() for c in batch.columns)):
                own = Chunk(deal.value, *row)
                paired, pair_n = own.paired(deal.value, pairs, pair, m)
                trained = np.repeat(~np.array(held), row[0])[own.live]
                n = np.bincount(own.which, trained, len(own.part)).astype(np.int64)
                # a chunk without contexts asks for nothing, so that it gets an answer
                ends = np.append(np.flatnonzero(np.diff(own.part)) + 1, len(own.part))
                part = own.part[ends - 1] if len(n) else np.zeros(1, np.int64)
                same = own.part == np.append(-1, own.part[:-1])
                # steps from the key before in the message pack better
                a, b = (x - np.append(0, x[:-1]) * same for x in (own.a, own.b))
                rare, paired = (np.cumsum(np.append(0, x))[ends] for x in (own.rare, paired))
                rare_n = own.n[own.in_chunk[own.rare]].astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(part), pa.array(np.full(len(ends), chunk)),
                    pa.array(np.diff(ends, prepend=0)), runs(a, ends), runs(folded(b), ends), runs(own.s, ends),
                    runs(n, ends), runs(rare_n, rare), runs(pair_n, paired)],
                    names=["part", "chunk", "size", "a", "b", "s", "n", "rare", "paired"])

    return chunks.select("chunk", "held_out", *ASKING, "pairs", "pair", "m").mapInArrow(
        run, "part long, chunk long, size long, a binary, b binary, s binary, n binary, rare binary, paired binary")


def hot_pairs(chunks: DataFrame, deal) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of the pairs of a hot symbol and a common next one, by key."""

    def run(batches):
        own = deal.value
        for batch in batches:
            for held, lengths, symbols in zip(*(c.to_pylist() for c in batch.columns)):
                s, a, _ = positions(symbols, lengths)
                use = own.of_common(own.hot, a, False) & (s < own.first) & np.repeat(~np.array(held), lengths)
                keys, n = np.unique(a[use] * own.first + s[use], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    found = chunks.select("held_out", "n_tokens", "symbols").mapInArrow(
        run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys, n = found.column("key").to_numpy(), found.column("n").to_numpy().astype(float)
    order = np.argsort(keys)
    return keys[order], n[order]


def hot_sums(chunks: DataFrame, deal: Deal, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each hot symbol the sums of `parts_of` over all its next symbols."""

    def run(batches):
        total = sum(np.frombuffer(x).reshape(3, -1) for batch in batches
                    for x in batch.column(0).to_pylist() if x)
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.shape[1])), *map(pa.array, total)], names=["hot", *"abc"])

    keys, n = pairs
    hot, s = keys // deal.first, keys % deal.first
    terms = parts_of(n, deal.context[hot], deal.root(deal.frequency[s]))
    sums = np.array([np.bincount(hot, x, deal.first) for x in terms])
    at = np.flatnonzero(deal.hot)
    for r in chunks.select("sums").mapInArrow(run, "hot long, a double, b double, c double").groupBy(
            "hot").sum("a", "b", "c").collect():
        sums[:, at[r[0]]] += r[1:]
    return sums


def grown(deal: Deal, frequencies: np.ndarray, numbers: np.ndarray, keys: tuple[np.ndarray, ...],
          n: np.ndarray, n1: np.ndarray, sums: np.ndarray) -> Tree:
    """The part of the tree that holds the contexts of the keys (one before, two before, symbol), given
    by places among the sorted numbers, with frequencies of the symbols and training counts n of the
    keys. These are whole but for pairs of hot symbols and next ones; of those, n1 and the sums are given."""
    tree = Tree(frequencies, deal.total, deal.size)
    size = tree.size
    a, b, s = keys
    hot = deal.of_common(deal.hot, numbers, False)
    # next symbols of the last symbol alone
    used = np.where(hot[a], n1 > 0, n > 0)
    own, first, of = np.unique((a * size + s)[used], return_index=True, return_inverse=True)
    counts = np.where(hot[own // size], n1[used][first], np.bincount(of, n[used], len(own)))
    add_contexts(tree, own // size, (own // size)[:, None], own % size, counts, (
        hot, deal.of_common(deal.context, numbers, 0.0),
        np.array([deal.of_common(x, numbers, 0.0) for x in sums])))
    # of the last two; a symbol two before that stands for several is in no context
    used = (n > 0) & (numbers[b] != OTHER)
    a, b, s, n = a[used], b[used], s[used], n[used]
    at, alive = tree.contexts(a[:, None], 1, None)
    a, b, s, n = a[alive], b[alive], s[alive], n[alive]
    add_contexts(tree, at[alive] * size + b, np.column_stack([a, b]), s, n)
    return tree


def add_contexts(tree: Tree, context: np.ndarray, path: np.ndarray, symbol: np.ndarray,
                 n: np.ndarray, whole: tuple[np.ndarray, ...] | None = None) -> None:
    """A level of the tree from its contexts' next symbols and their counts. `whole`: by context,
    which have their total and sums given, and these."""
    contexts, of = np.unique(context, return_inverse=True)
    total = np.bincount(of, n, len(contexts))
    if whole is not None:
        total = np.where(whole[0][contexts], whole[1][contexts], total)
    enough = total >= LEAST
    use = enough[of]
    contexts, total, of = contexts[enough], total[enough], (np.cumsum(enough) - 1)[of[use]]
    tree.add_level(contexts, total, of, symbol[use], n[use], path[use],
                   None if whole is None else (whole[0][contexts], whole[2][:, contexts]))


def answered(requests: DataFrame, deal, pairs, sums) -> DataFrame:
    """Per chunk and part the log10 probabilities of what was asked, in the same order."""

    def received(messages: pa.Table, sizes: np.ndarray):
        """One before, two before, symbol, its count, that after a hot symbol, and the keys' training counts."""
        own, (pair_keys, pair_n) = deal.value, pairs.value
        column = lambda c: messages.column(c).to_pylist()
        a, s, n = (np.concatenate([wide(x, k) for x, k in zip(column(c), sizes)]) for c in "asn")
        b = np.concatenate([unfolded(wide(x, k)) for x, k in zip(column("b"), sizes)])
        ends = np.cumsum(sizes)
        first = np.repeat(ends - sizes, sizes)
        sums_of = lambda x: np.cumsum(x) - np.append(0, np.cumsum(x))[first]
        a, b = sums_of(a), sums_of(b)  # from 0 in each message
        rare, hot = s >= own.first, own.of_common(own.hot, a, False)
        of_s, n1 = own.of_common(own.frequency, s, 0.0), np.zeros(len(a))
        for values, where, name in ((of_s, rare, "rare"), (n1, rare & hot, "paired")):
            many = np.diff(np.append(0, np.cumsum(where))[ends], prepend=0)
            values[where] = np.concatenate([wide(x, k) for x, k in zip(column(name), many)])
        common = ~rare & hot
        at, known = placed(pair_keys, a[common] * own.first + s[common])
        n1[common] = np.where(known, pair_n[at] if len(pair_n) else 0, 0)
        return a, b, s, of_s, n1, n

    def local(a, b, s, of_s):
        """The sorted numbers, the frequencies of the symbols, and the distinct keys by places among them."""
        numbers, index = np.unique(np.concatenate([a, b, s]), return_inverse=True)
        a, b, s = np.split(index, 3)
        frequencies = np.zeros(len(numbers))
        frequencies[s] = of_s
        return numbers, frequencies, *distinct(a, b, s, len(numbers))

    def answer(messages: pa.Table) -> pa.Table:
        sizes = messages.column("size").to_numpy()
        *keys, n1, n = received(messages, sizes)
        numbers, frequencies, a, b, s, which = local(*keys)
        del keys
        whole = np.empty(len(a))
        whole[which] = n1
        n = np.bincount(which, n, len(a))
        tree = grown(deal.value, frequencies, numbers, (a, b, s), n, whole, sums.value)
        logs = tree.logs(np.column_stack([a, b]), s).astype(np.float32)[which]
        return pa.table([messages.column("chunk"), messages.column("part"), messages.column("size"),
                         runs(logs, np.cumsum(sizes), squeezed)], names=["chunk", "part", "size", "logs"])

    return requests.groupBy("part").applyInArrow(answer, "chunk long, part long, size long, logs binary")


def scored(chunks: DataFrame, answers: DataFrame, deal, floor: float) -> DataFrame:
    """The texts of the named chunks with their scores."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for ids, held, *row in zip(*(c.to_pylist() for c in texts.columns[1:])):
            own, lengths = Chunk(deal.value, *row), row[0]
            order = np.argsort(answers.column("part").to_numpy())
            got, sizes = (answers.column(c).to_pylist() for c in ("logs", "size"))
            logs = np.concatenate([loose(got[i], sizes[i], np.float32) for i in order]).astype(float)
            n = own.n[own.symbols]
            tree = np.log10(deal.value.root(n)).astype(np.float32).astype(float)
            tree[own.live] = logs[own.which]
            sums = lambda x: np.add.reduceat(x, np.cumsum(lengths) - lengths)
            out.append((ids, held, lengths, sums((n > 0).astype(np.int64)).tolist(),
                        (sums(np.log10(n + 1)) - np.array(lengths) * floor).tolist(), sums(tree).tolist()))
        return pa.table([pa.array(list(itertools.chain.from_iterable(x)), k) for x, k in zip(
            zip(*out), (*KINDS[:3], pa.int64(), pa.float64(), pa.float64()))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return chunks.select("chunk", "doc_id", "held_out", *ASKING).groupBy("chunk").cogroup(
        answers.groupBy("chunk")).applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, "
                                                    "n_known long, base_score double, score double")


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of all documents."""
    symbols = symbols_of(word_counts(docs))
    total = symbols.total
    sc = docs.sparkSession.sparkContext
    chunks = cut_lineage(coded(docs, sc.broadcast(symbols)))
    if total:
        starts, words = chunks.agg(F.sum(F.size(F.filter("held_out", lambda h: ~h))), F.sum("n_words")).first()
        least = 4 * sc.defaultParallelism
        own = Deal(symbols, starts, max(least, (total + starts) // PART), max(least, words // BUCKET))
        deal, pairs = sc.broadcast(own), hot_pairs(chunks, sc.broadcast(own))
        chunks = cut_lineage(named(chunks, numbered(mentioned(chunks, deal), deal), deal))
        sums = sc.broadcast(hot_sums(chunks, own, pairs))
        answers = answered(asked(chunks, deal), deal, sc.broadcast(pairs), sums)
        facts = scored(chunks, answers, deal, math.log10(total + symbols.size))
    else:
        lists = ["doc_id", "held_out", "n_tokens", "score"]
        zero = F.lit(0.0)
        facts = chunks.select(F.explode(F.arrays_zip(*lists)).alias("d")).select(
            "d.doc_id", "d.held_out", "d.n_tokens", F.lit(0).cast("long").alias("n_known"),
            zero.alias("base_score"), "d.score")
    return facts.select("doc_id", "held_out", "n_tokens", "n_known",
                        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
