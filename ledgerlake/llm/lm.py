"""Language-model scores of documents: a word unigram base and a causal self-attention model.

Spark counts every word of the training documents. The counts give the base score, and, through the
subwords of each distinct word, the subword shares of the attention model, so both rest on the whole
training corpus. The attention layer is started off on the driver on sampled windows and then trained on
every subword of the training documents: executors add up gradients, Spark adds them up per parameter row.

The most frequent words are sent to the executors, which look up most tokens; only the other words are
shuffled to meet their counts.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, compress

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ledgerlake.llm.attention import BLOCK, WIDTH, Attention, Sums, Tables, rows_of
from ledgerlake.llm.common import cut, numbered, shared_dir, smallest_hashes, table, whole_text

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
BEGIN, END = 1, 2
FOLDS, HELD_OUT = 7, 2
#: Words that are sent to executors with their counts, and the longest of them in bytes.
HEAD_WORDS, HEAD_BYTES = 1 << 17, 64
#: Windows of 2 * BLOCK subwords that start the attention layer off, one from a document.
TRAIN_WINDOWS = 4000
#: Steps in which the whole training corpus is read once, and the fewest words of a step on average.
WHOLE_STEPS, STEP_WORDS = 32, 4096
#: Targets of a stored piece (a multiple of BLOCK), words of a step that a task gets, pieces that a task holds at once.
PIECE, TASK_WORDS, HELD_PIECES = 64 * BLOCK, 1 << 20, 100
#: Texts whose other words a task holds while it scores them.
HELD_TEXTS = 1000
#: Distinct words that a task holds before it passes on its counts or forgets its lookups.
HELD_WORDS = 400_000
#: Words of texts that are scored together; longer texts are scored in pieces of this many.
GROUP_WORDS = 100_000


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased."""
    return text.lower().split()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of a task's texts, in parts; one end per text is the empty word."""
    held: Counter[bytes] = Counter()

    def part() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            held.update(words_of(text))
            held[b""] += 1
            if len(held) > HELD_WORDS:
                yield part()
    if held:
        yield part()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over all training documents; the empty word counts the ends of texts."""
    texts = docs.where(~held_out(F.col("doc_id"))).select(whole_text("text").alias("text"))
    return texts.mapInArrow(_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_words(counts: DataFrame, most: int | None = None) -> DataFrame:
    """The words above the lowest count that at most ``most`` (HEAD_WORDS) words of HEAD_BYTES bytes reach.

    The count is read off a histogram: exact below 1024, in eighths of a doubling above. So what comes to
    the driver is the histogram and the head itself, whatever the number of partitions.
    """
    words = counts.where(F.length("word").between(1, HEAD_BYTES))
    eighth = F.floor(F.log2(F.col("n")) * 8)
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(1024 + eighth)
    words = words.withColumn("step", step)
    left, lowest = HEAD_WORDS if most is None else most, None
    for row in words.groupBy("step").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect():
        if row["words"] > left:
            break
        left, lowest = left - row["words"], row["step"]
    return words.where(F.lit(False) if lowest is None else F.col("step") >= lowest).select("word", "n")


def _encode(proto: bytes, words: list[bytes]) -> list[list[int]]:
    tool = sentencepiece.SentencePieceProcessor(model_proto=proto)
    return tool.encode([w.decode("utf-8", "replace") for w in words], num_threads=1) if words else []


def subword_counts(counts: DataFrame, proto: bytes) -> np.ndarray:
    """The corpus count of every subword, from the counts of distinct words."""
    size = sentencepiece.SentencePieceProcessor(model_proto=proto).vocab_size()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            words, ns = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            ids = _encode(proto, words)
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            total += np.bincount(flat, np.repeat(ns, [len(own) for own in ids]), size)
            total[END] += sum(n for w, n in zip(words, ns.tolist(), strict=True) if not w)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    rows = counts.select("word", "n").mapInArrow(split, "id long, n double").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size)
    for row in rows.collect():  # one row per subword of the vocabulary at most
        out[row["id"]] = row["n"]
    return out


def training_windows(docs: DataFrame, proto: bytes, windows: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """(inputs, targets) of windows from the training documents with the smallest hashes of their id."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def window(texts: pd.Series, places: pd.Series) -> pd.Series:
        out, n = [], 2 * BLOCK + 1
        for text, place in zip(texts, places, strict=True):
            words = words_of(text.encode())
            at = int(place % max(1, len(words) - BLOCK))
            ids = [i for own in _encode_kept(proto, words[at : at + n]) for i in own]
            if at + n >= len(words):
                ids.append(END)
            out.append((([BEGIN] if at == 0 else []) + ids)[:n])
        return pd.Series(out, dtype=object)

    place = F.xxhash64(F.col("doc_id"), F.lit("window"))
    rows = docs.where(~held_out(F.col("doc_id")))
    ids = smallest_hashes(rows.select("doc_id", place.alias("place")).distinct(), "place", windows)
    # at most ``windows`` ids of 16 bytes
    got = rows.join(F.broadcast(ids), "doc_id").select("doc_id", "place", window(whole_text("text"), F.pmod("place", F.lit(1 << 40))).alias("ids"))
    picked = [r["ids"] for r in got.orderBy("place", "doc_id", "ids").limit(windows).collect()]
    picked = [x for x in picked if len(x) > 1]
    ids_, target = np.zeros((len(picked), 2 * BLOCK), np.int64), np.full((len(picked), 2 * BLOCK), -1, np.int64)
    for row, x in enumerate(picked):
        ids_[row, : len(x) - 1] = x[:-1]
        target[row, : len(x) - 1] = x[1:]
    return ids_, target


def _training_pieces(proto: bytes) -> Callable:
    """(rid, piece, context, ids): all subwords of texts in pieces of PIECE targets, with the block before
    a piece; the first ``context`` inputs have no target there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(proto, [], np.zeros(0))
        group: list[tuple[int, list[bytes], bool, bool]] = []  # rid, words, from its start, to its end
        tail: dict[int, tuple[np.ndarray, int]] = {}  # the last inputs of a text's earlier words, and its pieces

        def part() -> pa.RecordBatch:
            ids, sizes = lexicon.subwords(lexicon.numbers(list(chain.from_iterable(own for _, own, _, _ in group))))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            rids, numbers, contexts, held, at = [], [], [], [], 0
            for rid, own, begins, closes in group:
                before, number = (np.array([BEGIN]), 0) if begins else tail.pop(rid)
                row = np.concatenate([before, ids[ends[at] : ends[at + len(own)]], [END] if closes else []]).astype(np.int32)
                for start in range(len(before) - 1, len(row) - 1, PIECE):
                    low = max(0, start - BLOCK)
                    rids.append(rid)
                    numbers.append(number)
                    contexts.append(start - low)
                    held.append(row[low : start + PIECE + 1])
                    number += 1
                if not closes:
                    tail[rid] = row[-BLOCK - 1 :], number
                at += len(own)
            group.clear()
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in held], dtype=np.int32)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *held])))
            return pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(contexts, pa.int32()), lists], names=["rid", "piece", "context", "ids"]
            )

        words = 0
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                pieces = list(_pieces(words_of(text)))
                for i, own in enumerate(pieces):
                    group.append((rid, own, i == 0, i == len(pieces) - 1))
                    words += len(own) + 1
                    if words >= GROUP_WORDS:
                        yield part()
                        words = 0
        if group:
            yield part()

    return run


def training_pieces(docs: DataFrame, proto: bytes, tokens: int, steps: int) -> DataFrame:
    """step, context, ids: every subword of the training documents, dealt to the steps, as a stored table.

    A step lies in files of its own, in so many that a task has about TASK_WORDS words of it.
    """
    texts = numbered(docs.where(~held_out(F.col("doc_id"))).select(whole_text("text").alias("text"))).select("rid", "text")
    rows = texts.mapInArrow(_training_pieces(proto), "rid long, piece long, context int, ids array<int>")
    deals = max(6, tokens // (steps * TASK_WORDS))
    rows = rows.withColumn("step", F.pmod(F.xxhash64("rid", "piece"), F.lit(steps)).cast("int"))
    rows = rows.withColumn("deal", F.pmod(F.xxhash64("piece", "rid", F.lit("deal")), F.lit(deals)))
    path = f"{shared_dir(docs.sparkSession)}/llm-{uuid.uuid4().hex}"
    rows.repartition("step", "deal").select("context", "ids", "step").write.partitionBy("step").parquet(path)
    return docs.sparkSession.read.schema("context int, ids array<int>, step int").parquet(path)


def _gradients(sent) -> Callable:
    """(row, g0, g1, ...): a task's sums of gradients, for the parameter rows that it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for at in range(0, batch.num_rows, HELD_PIECES):
                some = batch.slice(at, HELD_PIECES)
                sequences = []
                for context, ids in zip(some.column(0).to_pylist(), some.column(1), strict=True):
                    ids = ids.values.to_numpy().astype(np.int64)
                    goal = ids[1:].copy()
                    goal[:context] = -1
                    sequences.append((ids[:-1], goal))
                sums = sums or Sums(*sent.value)
                sums.add(*rows_of(sequences)[:3])
        if sums is not None:
            total = sums.packed()
            met = np.flatnonzero(total.any(axis=1))
            columns = [pa.array(total[met, i]) for i in range(WIDTH)]
            yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), *columns], names=["row", *(f"g{i}" for i in range(WIDTH))])

    return run


def train_whole(model: Attention, pieces: DataFrame, steps: int) -> list[float]:
    """Trains the model on every piece, a step's pieces at a time; the mean losses on the way.

    Only sums per parameter row, one row each, come to the driver.
    """
    context = pieces.sparkSession.sparkContext
    schema = "row long, " + ", ".join(f"g{i} double" for i in range(WIDTH))
    size = len(model.packed()) + 1

    def sums() -> Iterator[np.ndarray | None]:
        for step in range(steps):
            sent = context.broadcast(({name: v.astype(np.float32) for name, v in model.p.items()}, model.of))
            parts = pieces.where(F.col("step") == step).select("context", "ids").mapInArrow(_gradients(sent), schema)
            got = parts.groupBy("row").agg(*(F.sum(f"g{i}").alias(f"g{i}") for i in range(WIDTH))).toArrow()
            sent.destroy()
            if not got.num_rows:
                yield None
                continue
            out = np.zeros((size, WIDTH))
            out[got.column("row").to_numpy()] = np.stack([got.column(f"g{i}").to_numpy() for i in range(WIDTH)], axis=1)
            yield out

    return model.descend(sums(), steps)


_TOOLS: dict[bytes, Callable] = {}


def _encode_kept(proto: bytes, words: list[bytes]) -> list[list[int]]:
    """``_encode`` with the tool kept between texts."""
    if proto not in _TOOLS:
        tool = sentencepiece.SentencePieceProcessor(model_proto=proto)
        _TOOLS[proto] = lambda ws: tool.encode([w.decode("utf-8", "replace") for w in ws], num_threads=1)
    return _TOOLS[proto](words) if words else []


class _Index(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


class Lexicon:
    """Words as numbers, with their subwords; the head's words come first and are never forgotten."""

    def __init__(self, proto: bytes, head: list[bytes], logs: np.ndarray):
        self.proto, self.head, self.logs = proto, head, logs
        ids = _encode(proto, head)
        self.head_sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.head_flat = np.fromiter(chain.from_iterable(ids), np.int32)
        self.index: _Index | None = None

    def forget(self) -> None:
        self.index = _Index(zip(self.head, range(len(self.head)), strict=True))
        self.index.new = []
        self.sizes, self.flat = self.head_sizes, self.head_flat

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if self.index is None or len(self.index) > len(self.head) + HELD_WORDS:
            self.forget()
        out = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            ids = _encode_kept(self.proto, self.index.new)
            self.index.new = []
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, ids), np.int64, len(ids))])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32)])
            self.starts = None
        return out

    def subwords(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' subwords in a row, and how many each word has."""
        if getattr(self, "starts", None) is None or len(self.starts) != len(self.sizes):
            self.starts = np.cumsum(self.sizes) - self.sizes
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.starts[numbers] - (ends - sizes), sizes)], sizes


def _pieces(text: list[bytes]) -> Iterator[list[bytes]]:
    for at in range(0, max(1, len(text)), GROUP_WORDS):
        yield text[at : at + GROUP_WORDS]


def _score(lexicon: Lexicon, tables: Tables, texts: list[bytes]) -> list[tuple[int, int, float, float, Counter]]:
    """(n_tokens, known, base, score, other words) of texts; base is the sum of log10(c + 1) of head words."""
    out = [[1, 0, 0.0, 0.0, Counter()] for _ in texts]  # the end is a token
    group: list[tuple[int, list[bytes], bool, bool]] = []  # text, words, from its start, to its end
    tail: dict[int, np.ndarray] = {}  # the last inputs of a text's earlier pieces

    def run() -> None:
        words = list(chain.from_iterable(own for _, own, _, _ in group))
        numbers = lexicon.numbers(words)
        ids, sizes = lexicon.subwords(numbers)
        head = numbers < len(lexicon.head)
        logs = np.where(head, lexicon.logs[np.where(head, numbers, 0)], 0.0) if len(lexicon.head) else np.zeros(len(numbers))
        ends = np.cumsum(sizes)
        sequences, at = [], 0
        for n, own, begins, closes in group:
            upto = at + len(own)
            part = ids[(ends[at - 1] if at else 0) : (ends[upto - 1] if upto else 0)].astype(np.int64)
            known = int(head[at:upto].sum())
            out[n][0] += len(own)
            out[n][1] += known
            out[n][2] += float(logs[at:upto].sum())
            if known < len(own):
                out[n][4].update(compress(own, (~head[at:upto]).tolist()))
            goal = np.append(part, END) if closes else part
            before = np.array([BEGIN]) if begins else tail.pop(n)
            inputs = np.concatenate([before, part])
            if not closes:
                tail[n] = inputs[-BLOCK - 1 :]
                inputs = inputs[:-1]
            # inputs before the first target are context only
            sequences.append((inputs, np.concatenate([np.full(len(inputs) - len(goal), -1), goal])))
            at = upto
        rows, target, first, starts = rows_of(sequences)
        sums = np.add.reduceat(tables.log10(rows, target, first).sum(axis=1), starts)
        for (n, *_), total in zip(group, sums.tolist(), strict=True):
            out[n][3] += total
        group.clear()

    held = 0
    for n, text in enumerate(texts):
        pieces = list(_pieces(words_of(text)))
        for i, own in enumerate(pieces):
            group.append((n, own, i == 0, i == len(pieces) - 1))
            held += len(own)
            if held >= GROUP_WORDS:
                run()
                held = 0
    if group:
        run()
    return [tuple(x) for x in out]


def _listed(counts: list[Counter]) -> pa.Array:
    """Every counter as a list of (word, n)."""
    words = pa.array(list(chain.from_iterable(counts)), pa.binary())
    ns = pa.array(list(chain.from_iterable(c.values() for c in counts)), pa.int64())
    offsets = pa.array(np.cumsum([0, *map(len, counts)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([words, ns], names=["word", "n"]))


def _scores(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, tables = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, HELD_TEXTS):
                some = batch.slice(at, HELD_TEXTS)
                got = _score(lexicon, tables, some.column(3).cast(pa.binary()).to_pylist())
                cols = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], *cols, _listed([g[4] for g in got])],
                    names=["rid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "others"],
                )

    return run


def score(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    A null or empty text has one token, its end. A null id is not held out. Repeated rows are rows of
    their own and count as often in training. Without training documents nothing is known and the model
    is the untrained one. Other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with open(tokenizer, "rb") as file:
        proto = file.read()
    counts = cut(word_counts(docs))
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.max(F.when(F.length("word") == 0, F.col("n"))).alias("ends")).first()
    tokens, distinct, ends = total["n"] or 0, total["v"], total["ends"] or 0
    model = Attention(subword_counts(counts, proto))
    model.train(*training_windows(docs, proto))
    if tokens:
        steps = min(WHOLE_STEPS, max(1, tokens // STEP_WORDS))
        train_whole(model, training_pieces(docs, proto, tokens, steps), steps)
    rows = [(bytes(r["word"]), r["n"]) for r in head_words(counts).orderBy(F.desc("n"), "word").collect()]
    logs = np.log10(np.array([n + 1 for _, n in rows], float))
    sent = docs.sparkSession.sparkContext.broadcast((Lexicon(proto, [w for w, _ in rows], logs), model.tables()))
    texts = numbered(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), whole_text("text").alias("text")))
    schema = "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, others array<struct<word:binary,n:long>>"
    scored = cut(texts.select("rid", "doc_id", "held_out", "text").mapInArrow(_scores(sent), schema))
    others = scored.select("rid", F.explode("others").alias("o")).select("rid", "o.word", F.col("o.n").alias("times"))
    met = others.join(counts, "word").groupBy("rid").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    out = scored.drop("others").join(met, "rid", "left")
    end_log, each = float(np.log10(ends + 1)), float(np.log10(tokens + distinct + 1))
    none = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", none) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        "score",
    )


def op6_attention_scores(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
