"""Language-model scores of whole texts.

Two scores learn from the rows outside the held-out tenth. The base score is a smoothed word
unigram: counts of all words, joined back to the texts that hold them. The model score is a
causal self-attention network over subword ids of the same words (see `attention`): its
in-class token shares come from the counts of all training words, its weights from all tokens
of all training rows. Each task of a round goes over its rows from the same weights; the mean
of what the tasks arrive at, by their tokens, is where the next round begins.

Texts are dealt into blocks of about `BLOCK_BYTES` by a hash of key and text. A block sends each
of its words once, however often it holds it, and gets the word's count back once, so that the
shuffle grows with distinct words and a word in every text costs one row per block.

Null and empty texts have one token, the end; texts of any length are scored whole (a block is
as large as its longest text at least); repeated rows are scored each; rows with a null key
teach, as their remainder is unknown; without training rows the base score is 0 and the model
is uniform over its classes; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm import attention
from skyrisk.llm.shared import landed
from skyrisk.llm.texts import held_out, slices

BLOCK_BYTES = 8 << 20
ROUNDS = 2  # passes over all training rows
GROUP = 200_000  # tokens held at once
START, END = "<|startoftext|>", "<|endoftext|>"


class Subwords:
    """Ids of single words by a public vocabulary file; white space is not encoded."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        self.start, self.end = self.tokenizer.token_to_id(START), self.tokenizer.token_to_id(END)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        out = []
        for at in range(0, len(words), 2000):
            part = [w.decode("utf-8", "replace") for w in words[at : at + 2000]]
            out += [np.array(c.ids, "<u4").tobytes() for c in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return out


@lru_cache(maxsize=2)
def subwords(path: str) -> Subwords:
    return Subwords(path)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of texts, A-Z lowered, one behind another (runs without ASCII white space), and which text each is of."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    words = lists.flatten()
    some = pc.not_equal(words, "")  # white space at an end of a text leaves an empty word
    return words.filter(some).cast(pa.binary()), of[some.to_numpy(zero_copy_only=False)]


def _bytes(column: pa.Array) -> list[bytes]:
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in column]


def _release() -> None:
    """Give back what Arrow keeps of freed memory: the worker goes on to other tasks, beside the executor's."""
    pa.default_memory_pool().release_unused()


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each block with their training count; rows arrive block by block."""
    found: list[tuple[pa.Array, np.ndarray]] = []  # of the current block: words and counts, slice by slice
    current: int | None = None

    def out() -> Iterator[pa.RecordBatch]:
        if found:
            words = pa.concat_arrays([w for w, _ in found]).dictionary_encode()
            n = np.bincount(words.indices.to_numpy(), np.concatenate([c for _, c in found])).astype(np.int64)
            block = pa.array(np.full(len(n), current, np.int32))
            whole = pa.RecordBatch.from_arrays([words.dictionary, block, pa.array(n)], ["word", "block", "n"])
            for at in range(0, len(n), 50_000):
                yield whole.slice(at, 50_000)

    for batch in batches:
        for part in slices(batch):
            blocks = part.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if blocks[a] != current:
                    yield from out()
                    found, current = [], int(blocks[a])
                words, of = tokens(part.column(2).slice(a, b - a))
                if len(words):
                    teaches = ~part.column(1).slice(a, b - a).to_numpy(zero_copy_only=False)
                    words = words.dictionary_encode()
                    found.append((words.dictionary, np.bincount(words.indices.to_numpy(), teaches[of])))
    yield from out()
    found = []
    _release()


def _corpus_words(path: str):
    """Rows sorted by word, with the word's total count, its subword ids (encoded once for
    the whole corpus), and a mark on the first row of each word."""

    def out(rows: list[pa.RecordBatch], sub: Subwords) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        word = t.column("word").chunk(0)
        new = np.r_[True, pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)]
        start = np.flatnonzero(new)
        total = np.add.reduceat(t.column("n").to_numpy(), start)
        of = np.cumsum(new) - 1
        ids = pa.array(sub.encode(_bytes(word.take(pa.array(start)))), pa.binary()).take(pa.array(of))
        return pa.RecordBatch.from_arrays(
            [t.column("block").chunk(0), word, pa.array(total[of]), ids, pa.array(new)], ["block", "word", "n", "ids", "first"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = Subwords(path)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last word may go on in the next batch; it has a row per block at most.
            other = pc.not_equal(batch.column(0), batch.column(0)[-1]).to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if held and (cut or held[-1].column(0)[-1] != batch.column(0)[-1]):
                yield out([*held, batch.slice(0, cut)], sub)
                held = []
            elif cut:
                yield out([batch.slice(0, cut)], sub)
            held.append(batch.slice(cut))
        if held:
            yield out(held, sub)
        held = []
        _release()

    return run


def _token_counts(size: int):
    """Counts of subword ids from counts of words, one row per id and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            ids, starts = _flat_ids(batch.column(0))
            total += np.bincount(ids, np.repeat(batch.column(1).to_numpy(), np.diff(starts)), size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    return run


def _flat_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all values one behind another, and where each begins (and the last ends)."""
    starts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 4
    data = np.frombuffer(column.buffers()[2] or b"", "<u4", count=-1) if column.buffers()[2] else np.zeros(0, "<u4")
    return data[starts[0] : starts[-1]], starts - starts[0]


def _joined(flat: np.ndarray, starts: np.ndarray, at: np.ndarray, of: np.ndarray, sizes: np.ndarray, n: int, end: int) -> pa.Array:
    """The ids of each of `n` texts, and the `end` behind them: `at` are the words of all texts, `of` whose they are."""
    lengths = np.bincount(of, sizes[at], n).astype(np.int64) + 1
    until = np.cumsum(lengths)
    out = np.empty(int(until[-1]) if n else 0, "<u4")
    inner = np.ones(len(out), bool)
    inner[until - 1], out[until - 1] = False, end
    ids = np.empty(len(out) - n, "<u4")
    done = 0
    for i in range(0, len(at), GROUP):
        part = at[i : i + GROUP]
        k = sizes[part]
        ids[done : done + k.sum()] = flat[np.arange(k.sum()) + np.repeat(starts[part] - (np.cumsum(k) - k), k)]
        done += k.sum()
    out[inner] = ids
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.r_[0, until * 4].astype(np.int32)), pa.py_buffer(out)])


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Texts of a batch in groups, so that the arrays of the network stay small: which rows,
    their ids one behind another, and their lengths."""
    if not batch.num_rows:
        return
    flat, starts = _flat_ids(batch.column(batch.schema.get_field_index("ids")))
    edges = np.flatnonzero(np.diff(np.r_[-1, starts[1:] // GROUP]))
    for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
        yield slice(a, b), flat[starts[a] : starts[b]], np.diff(starts[a : b + 1])


def _round(vocabulary: attention.Vocabulary, weights: attention.Parameters, rate: float, start: int):
    """The weights after all rows of a task, times their tokens, and the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, tokens, held, size = attention.Fit(weights, rate), 0, [], 0

        def over() -> None:
            flat, lengths = (np.concatenate(x) for x in zip(*held, strict=True))
            fit.over(*attention.examples(vocabulary, flat, lengths, start))

        for batch in batches:
            for _, flat, lengths in _groups(batch):
                if size and size + len(flat) > GROUP:
                    over()
                    held, size = [], 0
                held.append((flat, lengths))
                size += len(flat)
                tokens += len(flat)
        if held:
            over()
            yield pa.RecordBatch.from_pydict({"weights": pa.array([(attention.vector(fit.p) * tokens).tobytes()], pa.binary()), "tokens": pa.array([tokens], pa.int64())})

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, tokens = None, 0
    for batch in batches:
        for v, n in zip(_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            v = np.frombuffer(v)
            total, tokens = v if total is None else total + v, tokens + n
    if total is not None:
        yield pa.RecordBatch.from_pydict({"weights": pa.array([total.tobytes()], pa.binary()), "tokens": pa.array([tokens], pa.int64())})


def _trained(sequences: DataFrame, vocabulary: attention.Vocabulary, start: int) -> attention.Parameters:
    """The network after `ROUNDS` rounds, each once over all rows that are not held out, whatever
    the size of the corpus."""
    network, schema = attention.initial(), "weights binary, tokens long"
    for i in range(ROUNDS):
        done = landed(sequences.where("NOT held_out").select("ids").mapInArrow(_round(vocabulary, network, 4e-3 / (1 + i), start), schema), "weights")
        sums = done.coalesce(8).mapInArrow(_sums, schema).collect()  # a row per task
        if not sums:
            break
        network = attention.parameters(sum(np.frombuffer(r["weights"]) for r in sums) / sum(r["tokens"] for r in sums))
    return network


def score(df: DataFrame, vocabulary_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), held_out(key, 10, 0).alias("held"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.count("*").alias("n"), F.sum((~F.col("held")).cast("long")).alias("train"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_blocks = max(1, -(-(size["bytes"] or 0) // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("key", "text"), F.lit(n_blocks)).cast("int").alias("block")
    dealt = rows.select(block, "held", "text", "key", F.xxhash64("key", "text").alias("order"))

    ordered = dealt.select("block", "held", "text").repartition(n_blocks, "block").sortWithinPartitions("block")
    found = ordered.mapInArrow(_block_words, "word binary, block int, n long")
    by_word = found.repartition("word").sortWithinPartitions("word")
    words = landed(by_word.mapInArrow(_corpus_words(vocabulary_file), "block int, word binary, n long, ids binary, first boolean"), "words")
    # One row per distinct word of the corpus; the end token is added by hand.
    distinct = words.where("first AND n > 0")
    totals = distinct.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    ends = size["train"] or 0
    n_train, n_distinct = (totals["n"] or 0) + ends, totals["words"] + (ends > 0)

    sub = subwords(vocabulary_file)
    counts = np.zeros(sub.size)
    counted = distinct.select("ids", "n").mapInArrow(_token_counts(sub.size), "id long, n double")
    for r in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():  # bounded by the vocabulary
        counts[r["id"]] = r["n"]
    counts[sub.end] += ends
    vocabulary = attention.Vocabulary(counts)

    log_of = lambda c: np.log10((c + 0.1) / (n_train + 0.1 * (n_distinct + 1)))
    end_score = float(log_of(ends))
    start, end = sub.start, sub.end

    def block_sequences(_: tuple, texts: pa.Table, counted: pa.Table) -> pa.Table:
        texts, counted = texts.sort_by("order"), counted.combine_chunks()
        c = counted.column("n").to_numpy()
        names = counted.column("word").chunk(0) if len(c) else pa.array([], pa.binary())
        base, is_known = log_of(c), c > 0
        flat, starts = _flat_ids(counted.column("ids").chunk(0)) if len(c) else (np.zeros(0, "<u4"), np.zeros(1, np.int64))
        sizes = np.diff(starts)
        done = []
        for batch in (part for whole in texts.to_batches() for part in slices(whole)):
            words, of = tokens(batch.column("text"))
            at = pc.index_in(words, value_set=names).to_numpy(zero_copy_only=False)
            count = lambda weights=None: np.bincount(of, weights, batch.num_rows)  # noqa: B023, E731
            done.append(
                pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"), batch.column("held"), pa.array(count() + 1), pa.array(count(is_known[at]).astype(np.int64) + (ends > 0)),
                        pa.array(np.full(batch.num_rows, n_train)), pa.array(count(base[at]) + end_score), _joined(flat, starts, at, of, sizes, batch.num_rows, end),
                    ],
                    [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "ids"],
                )
            )
        _release()
        return pa.Table.from_batches(done)

    schema = f"{key} {key_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
    paired = dealt.groupBy("block").cogroup(words.select("block", "word", "n", "ids").groupBy("block"))
    sequences = landed(paired.applyInArrow(block_sequences, schema + "ids binary"), "sequences")
    network = _trained(sequences, vocabulary, start)

    def model_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, flat, lengths in _groups(batch):
                model = attention.log_probabilities(network, vocabulary, flat, lengths, start)
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(model, pa.float64())], [*part.schema.names[:-1], "score"])

    return sequences.mapInArrow(model_scores, schema + "score double")
