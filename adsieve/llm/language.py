"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The likelihood of a
word is the sum over all of its segmentations into pieces, found by a forward pass; the score of
a text is the sum of its words' log-likelihoods, since no piece of the vocabulary crosses a word.
Probabilities are learned by expectation maximisation (forward and backward passes) from labelled
texts: a hash sample of about ``sample_docs`` documents for each language, as documented below. Its
words are counted in Spark, and so are each round's expected pieces: what a task expects is summed in
fixed point, so that the sums are the same however rows are dealt.

A word's letters count, in lower case; other characters separate runs of letters. A run of any length is
scored whole. Only learning takes runs over ``RUN`` letters in parts, of which the first alone begins a
word. A letter that no piece covers alone has the fixed probability ``UNKNOWN``.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or where nothing
was labelled; ties go to the smaller language name; repeated rows are predicted each by itself;
other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.llm.storage import keep
from adsieve.llm.words import slices, sole

RUN = 32
UNKNOWN = 1e-7
BEGIN = "▁"
#: Words whose likelihoods a worker remembers at a time.
CACHE_WORDS = 600_000
#: Letters by Unicode category, with the marks that follow them; numbers such as ½ and Ⅷ are none.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: What probabilities are multiplied by for each character, so that sums over long runs stay far from the smallest double.
SCALE = 1e6
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def letter_runs(word: str) -> list[str]:
    """Runs of letters in lower case, each with the word-begin mark."""
    return [BEGIN + run for run in _LETTERS.findall(word.lower())]


def in_parts(run: str) -> list[str]:
    """A run in parts of at most RUN letters, for learning."""
    return [run[: RUN + 1], *(run[k : k + RUN] for k in range(RUN + 1, len(run), RUN))]


class Vocabulary:
    """Pieces by length and hash; finds all edges of a batch of runs at once."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
        pieces = [model.id_to_piece(k) for k in usable]
        pieces = [p for p in pieces if BEGIN not in p[1:] and len(p) <= RUN + 1]
        self.size = len(pieces)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({len(p) for p in pieces}):
            own = [k for k, p in enumerate(pieces) if len(p) == length]
            codes = np.array([[ord(c) for c in pieces[k]] for k in own], np.uint64)
            h = np.zeros(len(own), np.uint64)
            for column in codes.T:
                h = h * _BASE + column
            order = np.argsort(h)
            self.by_length[length] = (h[order], np.array(own, np.int32)[order])
        self.longest = max(self.by_length)

    def edges(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(from, to, piece or -1) ordered by place in the run; first and last node of each run."""
        codes = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32).astype(np.uint64)
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(runs)), lengths)
        at = np.arange(len(codes))
        room = ends[owner] - at
        place = lengths[owner] - room
        h = np.zeros(len(codes), np.uint64)
        found = []
        alone = np.zeros(len(codes), bool)
        for length in range(1, max(self.by_length) + 1):
            live = np.flatnonzero(room >= length)
            if not len(live):
                break
            h[live] = h[live] * _BASE + codes[live + length - 1]
            if length not in self.by_length:
                continue
            keys, pieces = self.by_length[length]
            k = np.minimum(np.searchsorted(keys, h[live]), len(keys) - 1)
            hit = keys[k] == h[live]
            start = live[hit]
            if length == 1:
                alone[start] = True
            found.append((start, np.full(len(start), length), pieces[k[hit]]))
        bare = np.flatnonzero(~alone)
        found.append((bare, np.ones(len(bare), np.int64), np.full(len(bare), -1, np.int32)))
        start, length, piece = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(place[start], kind="stable")
        start, length, piece = start[order], length[order], piece[order]
        node = start + owner[start]
        first = ends - lengths + np.arange(len(runs))
        self.steps = np.searchsorted(place[start], np.arange(int(lengths.max(initial=0)) + 1))
        return node, node + length, piece, first, first + lengths


def forward(edges: tuple, steps: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Sum over segmentations up to each node, for each language; p: a row for each edge."""
    first, last = edges[3:]
    alpha = np.zeros((int(last[-1]) + 1, p.shape[1]))
    alpha[first] = 1
    return _spread(alpha, edges, steps, p)


def _spread(alpha: np.ndarray, edges: tuple, steps: np.ndarray, p: np.ndarray) -> np.ndarray:
    source, target = edges[:2]
    for a, b in zip(steps[:-1], steps[1:]):
        for_lengths = target[a:b] - source[a:b]
        for length in np.unique(for_lengths):  # edges of one start and one length never share their end
            k = a + np.flatnonzero(for_lengths == length)
            alpha[target[k]] += alpha[source[k]] * p[k]
    return alpha


def backward(edges: tuple, steps: np.ndarray, p: np.ndarray) -> np.ndarray:
    source, target, _, first, last = edges
    beta = np.zeros((int(last[-1]) + 1, p.shape[1]))
    beta[last] = 1
    for a, b in zip(steps[:-1][::-1], steps[1:][::-1]):
        for_lengths = target[a:b] - source[a:b]
        for length in np.unique(for_lengths):
            k = a + np.flatnonzero(for_lengths == length)
            beta[source[k]] += beta[target[k]] * p[k]
    return beta


def of_pieces(table: np.ndarray, edges: tuple) -> np.ndarray:
    """Probabilities of the edges, times SCALE for each character: a whole run's sum has the factor SCALE ** its length."""
    source, target, piece, *_ = edges
    p = table[piece]
    p[piece < 0] = UNKNOWN
    return p * SCALE ** (target - source)[:, None].astype(float)


def run_scores(vocabulary: Vocabulary, table: np.ndarray, runs: list[str]) -> np.ndarray:
    """Log-likelihoods of runs of any length, a row for each and a column for each language."""
    out = np.zeros((len(runs), table.shape[1]))
    short = [k for k, run in enumerate(runs) if len(run) <= RUN + 1]
    if short:
        own = [runs[k] for k in short]
        edges = vocabulary.edges(own)
        lengths = np.fromiter(map(len, own), float, len(own))
        out[short] = np.log(forward(edges, vocabulary.steps, of_pieces(table, edges))[edges[4]]) - np.log(SCALE) * lengths[:, None]
    for k, run in enumerate(runs):
        if len(run) > RUN + 1:
            out[k] = long_score(vocabulary, table, run)
    return out


#: Blocks of a long run that are looked up at once.
BLOCKS = 256


def long_score(vocabulary: Vocabulary, table: np.ndarray, run: str) -> np.ndarray:
    """The same for one long run, block by block, so that no product leaves the range of doubles.

    A block is as long as the longest piece, so a piece reaches into the next block at most. What is carried over a border
    is, for each of the next block's nodes, the sum over segmentations whose first node beyond the border it is; a block
    maps these linearly onto those of the next border. They are scaled by their largest at each border.
    """
    wide = vocabulary.longest
    carried, scale = np.zeros((table.shape[1], wide)), np.zeros(table.shape[1])
    carried[:, 0] = 1
    starts = range(0, max(len(run) - 2 * wide + 2, 0), wide)
    for at in range(0, len(starts), BLOCKS):
        alpha, first, _ = _from_each(vocabulary, table, [run[b : b + 2 * wide - 1] for b in starts[at : at + BLOCKS]], wide)
        for block in alpha[first[:, None] + wide + np.arange(wide)]:
            carried = np.einsum("jlk,lk->lj", block, carried)
            largest = carried.max(axis=1)
            carried /= largest[:, None]
            scale += np.log(largest)
    rest = run[len(starts) * wide :]
    alpha, _, last = _from_each(vocabulary, table, [rest], len(rest))
    return np.log((alpha[last[0]] * carried).sum(axis=1)) + scale - np.log(SCALE) * len(run)


def _from_each(vocabulary: Vocabulary, table: np.ndarray, parts: list[str], stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums up to each node by language and by the part's node set out from, over pieces that begin before ``stop``."""
    edges = vocabulary.edges(parts)
    first, last = edges[3:]
    alpha = np.zeros((int(last[-1]) + 1, table.shape[1], vocabulary.longest))
    for j in range(min(vocabulary.longest, len(parts[0]) + 1)):
        alpha[first + j, :, j] = 1
    return _spread(alpha, edges, vocabulary.steps[: stop + 1], of_pieces(table, edges)[:, :, None]), first, last


#: Expected counts are summed in this many parts of one, as whole numbers: their sums don't depend on any order.
PARTS = 1 << 20


def expected(vocabulary: Vocabulary, column: np.ndarray, runs: list[str], times: np.ndarray) -> np.ndarray:
    """How often each piece is expected in runs of one language, in PARTS, given its probabilities (one column)."""
    counts = np.zeros(vocabulary.size)
    for at in range(0, len(runs), 20_000):
        part, weight = runs[at : at + 20_000], times[at : at + 20_000]
        edges = vocabulary.edges(part)
        source, target, piece, first, last = edges
        p = of_pieces(column, edges)
        alpha, beta = forward(edges, vocabulary.steps, p), backward(edges, vocabulary.steps, p)
        owner = np.searchsorted(first, source, side="right") - 1
        share = weight[owner] * alpha[source, 0] * p[:, 0] * beta[target, 0] / alpha[last[owner], 0]
        known = piece >= 0
        counts += np.bincount(piece[known], np.rint(share[known] * PARTS), vocabulary.size)
    return counts


def maximised(counts: np.ndarray) -> np.ndarray:
    """Probabilities of pieces from expected counts (in PARTS), a column for each language."""
    own = counts / PARTS
    return (own + 0.01) / (own.sum(axis=0) + 0.01 * len(own))


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def told() -> pa.RecordBatch:
        keys = list(counts)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "run", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, n in Counter(text.split()).items():
                for run in letter_runs(word):
                    for part in in_parts(run):
                        counts[lang, part] += n
            if len(counts) > CACHE_WORDS // 2:
                yield told()
                counts.clear()
    yield told()


def _expect(path: str, names: list[str], table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, counts = Vocabulary(path), np.zeros(table.shape)
        for batch in batches:
            langs, times = np.array(batch.column(0).to_pylist(), object), batch.column(2).to_numpy().astype(float)
            for column, name in enumerate(names):
                own = np.flatnonzero(langs == name)
                if len(own):
                    counts[:, column] += expected(vocabulary, table[:, [column]], batch.column(1).take(pa.array(own)).to_pylist(), times[own])
        piece, column = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(column.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(counts[piece, column].astype(np.int64))], ["column", "piece", "parts"])

    return run


def learn(runs: DataFrame, names: list[str], vocabulary_path: str, rounds: int = 3) -> np.ndarray:
    """Piece probabilities from (lang, run, n), a column for each language; a round is one Spark job.

    The driver gets one row for each piece and language that occur, whatever the number of runs.
    """
    size = Vocabulary(vocabulary_path).size
    table = np.full((size, len(names)), 1 / size)
    for _ in range(rounds):
        sums = runs.mapInArrow(_expect(vocabulary_path, names, table), "column int, piece int, parts long").groupBy("column", "piece").agg(F.sum("parts").alias("parts")).toArrow()
        counts = np.zeros(table.shape)
        counts[sums["piece"].to_numpy(), sums["column"].to_numpy()] = sums["parts"].to_numpy()
        table = maximised(counts)
    return table


def is_held_out(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (false for a null id)."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, vocabulary_path: str, sample_docs: int = 1500) -> tuple[list[str], np.ndarray]:
    """Learn from labelled documents that aren't held out.

    ``sample_docs``: bound of the sample, in expectation, for each language: a document is taken if
    a hash of its id falls below that share of its language's labelled documents.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return [], np.zeros((1, 0))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, min(1.0, sample_docs / n))]), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.where((draw < share) & F.col("text").isNotNull()).select("lang", F.col("text").cast("string").alias("text"))
    counted = sample.mapInArrow(_count_runs, "lang string, run string, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    runs = keep(counted.repartition(docs.sparkSession.sparkContext.defaultParallelism, "lang", "run"), "language-runs")
    names = sorted(r["lang"] for r in runs.select("lang").distinct().collect())
    return names, learn(runs, names, vocabulary_path) if names else np.zeros((1, 0))


class Scorer:
    """Log-likelihoods of words in every language, remembered in one table."""

    def __init__(self, path: str, names: list[str], table: np.ndarray) -> None:
        self.vocabulary, self.names, self.table = Vocabulary(path), names, table
        self.row: dict[bytes, int] = {}
        self.scores = np.zeros((CACHE_WORDS, len(names) + 1))  # the last column counts runs of letters

    def forget(self) -> None:
        """Keep the words met first, which are the frequent ones."""
        first = list(islice(self.row.items(), CACHE_WORDS // 4))
        self.row.clear()
        self.row.update(first)

    def add(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            runs = [letter_runs(w.decode("utf-8", "replace")) for w in part]
            n = np.fromiter(map(len, runs), np.int64, len(runs))
            base = len(self.row)
            self.row.update(zip(part, range(base, base + len(part))))
            self.scores[base : base + len(part)] = 0
            if n.any():
                flat = run_scores(self.vocabulary, self.table, [r for rs in runs for r in rs])
                owner = np.repeat(np.arange(len(part)), n)
                for k in range(flat.shape[1]):
                    self.scores[base : base + len(part), k] = np.bincount(owner, flat[:, k], len(part))
            self.scores[base : base + len(part), -1] = n

    def text(self, text: bytes) -> np.ndarray:
        total = np.zeros(len(self.names) + 1)
        for at, to in slices(text):
            words = text[at:to].split()
            rows = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
            total += self.scores[rows].sum(axis=0)
        return total

    def learn_words(self, texts: list[bytes]) -> None:
        fresh: set[bytes] = set()
        for text in texts:
            for at, to in slices(text):
                fresh.update(text[at:to].split())
        missing = fresh.difference(self.row)
        if len(self.row) + len(missing) > CACHE_WORDS:
            self.forget()
            missing = fresh.difference(self.row)
            if len(self.row) + len(missing) > len(self.scores):
                self.scores = np.resize(self.scores, (len(self.row) + len(missing), self.scores.shape[1]))
        self.add(list(missing))


_SCORERS: dict[str, Scorer] = {}


def scorer_for(path: str, names: list[str], table: np.ndarray) -> Scorer:
    """One scorer for a worker process and model, so that what it remembers serves later tasks."""
    key = f"{path} {names} {xxhash.xxh3_64_hexdigest(table.tobytes())}"
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(path, names, table)
    sole(_SCORERS[key].row)
    return _SCORERS[key]


def _predict(path: str, names: list[str], table: np.ndarray):
    out = ["doc_id", "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_for(path, names, table) if names else None
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, held = [], 0
                while at + len(texts) < batch.num_rows and held < 4 << 20 and len(texts) < 2000:
                    texts.append(batch.column(1)[at + len(texts)].as_py() or b"")
                    held += len(texts[-1])
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                langs, scores = [], []
                if scorer:
                    scorer.learn_words(texts)
                for text in texts:
                    total = scorer.text(text) if scorer else np.zeros(1)
                    if not total[-1]:
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    ll = total[:-1]
                    best = int(np.argmax(ll))
                    langs.append(names[best])
                    scores.append(float(1 / np.exp(ll - ll[best]).sum()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], out)

    return run


def predict(docs: DataFrame, vocabulary_path: str, model: tuple[list[str], np.ndarray], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (probability among the learned languages) of every row."""
    whole = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return whole.mapInArrow(_predict(vocabulary_path, *model), "doc_id long, lang_pred string, score double")
