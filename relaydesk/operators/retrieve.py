"""Nearest earlier inquiries by TF-IDF cosine.

``ReplyIndex`` holds unit vectors of the mined inquiries. Two exact ways lead
to the same neighbours:

* a table of mined replies whose counted postings and text bytes stay below the
  two limits goes to every task once, and a message is scored where it lies: no shuffle, so no skew;
* a larger table is joined on terms, a block of it and a slice of the messages
  at a time. For every message the terms that cannot lift a reply into the top
  k are left out first (the MaxScore bound of Turtle and Flood 1995), and equal
  messages are scored once. Pairs of messages and replies are not shuffled.

Messages that share a term with most replies, as long ones do, are scored some
at a time by :class:`_Sums`, in either way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.operators.tfidf import TfidfModel

MAX_BROADCAST_POSTINGS = 4_000_000
MAX_BROADCAST_TEXT = 256 * 1024 * 1024
# what a task of the join on terms holds at once
POSTINGS_PER_PIECE = 4_000_000
QUESTIONS_PER_SLICE = 20_000
# replies a message may touch nothing of for each posting it does, if all are summed
DENSE = 32
# messages with a posting for every TOGETHER replies are scored together, so many at once; terms that one of COMMON
# replies has are a matrix then. It and the sums have at most CELLS cells each, so neither grows with the replies
TOGETHER, MESSAGES_AT_ONCE, COMMON, CELLS = 2, 64, 32, 1 << 23
RUN = 64  # replies of which the best one is looked at first
# far more than sums of products of unit vectors are off in single precision
_SLACK = 1e-4
_PLACES = 9
_MARGIN = 1e-7

HITS = T.StructType(
    [
        T.StructField("kb_id", T.ArrayType(T.LongType())),
        T.StructField("score", T.ArrayType(T.DoubleType())),
    ]
)


@dataclass(frozen=True)
class ReplyIndex:
    """Mined replies with their vectors: ``vectors`` has (kb_id, inquiry, resolution, vec)."""

    model: TfidfModel
    vectors: DataFrame | None
    postings: int
    text_bytes: int = 0
    max_broadcast: int = MAX_BROADCAST_POSTINGS

    @classmethod
    def build(
        cls,
        replies: DataFrame,
        max_features: int = 5000,
        sublinear: bool = True,
        key: str = "conv_id",
        max_broadcast: int = MAX_BROADCAST_POSTINGS,
    ) -> ReplyIndex:
        """Fit the vocabulary on the inquiries and weigh them; an empty table gives an empty index."""
        kept = replies.select(
            F.col(key).cast("long").alias("kb_id"),
            F.col("customer_inquiry").alias("inquiry"),
            F.col("support_resolution").alias("resolution"),
        ).persist(StorageLevel.MEMORY_AND_DISK)
        kept.count()  # from here on its true size is known to the optimizer
        model = TfidfModel.fit(kept, "inquiry", max_features, sublinear)
        return cls.of_vectors(model, model.transform(kept, "inquiry").persist(StorageLevel.MEMORY_AND_DISK), max_broadcast)

    @classmethod
    def of_vectors(cls, model: TfidfModel, vectors: DataFrame, max_broadcast: int = MAX_BROADCAST_POSTINGS) -> ReplyIndex:
        """The index of replies (kb_id, inquiry, resolution, vec) weighed by ``model``."""
        size = vectors.agg(
            F.coalesce(F.sum(F.size("vec.idx") + 1), F.lit(0)).alias("postings"),
            F.coalesce(F.sum(F.octet_length("resolution")), F.lit(0)).alias("text_bytes"),
        ).first()
        return cls(model, vectors if size.postings else None, size.postings, size.text_bytes, max_broadcast)

    @property
    def fits_broadcast(self) -> bool:
        """Both the postings and the reply texts are small enough to be handed to every task."""
        return self.postings <= self.max_broadcast and self.text_bytes <= MAX_BROADCAST_TEXT

    @cached_property
    def shared_postings(self) -> Broadcast:
        """(ids, start of a term's postings, row of a posting, its weight), rows in order of kb_id."""
        rows = self.vectors.select("kb_id", "vec.idx", "vec.w").orderBy("kb_id").toPandas()
        ids = rows["kb_id"].to_numpy("int64")
        sizes = rows["idx"].map(len).to_numpy("int64")
        terms = np.concatenate([np.asarray(x, "int32") for x in rows["idx"]])
        weights = np.concatenate([np.asarray(x, "float64") for x in rows["w"]])
        order = np.argsort(terms, kind="stable")
        starts = np.searchsorted(terms[order], np.arange(len(self.model.terms) + 1))
        place = np.repeat(np.arange(len(ids)), sizes)[order]
        return self.vectors.sparkSession.sparkContext.broadcast((ids, starts, place, weights[order]))

    def with_broadcast_limit(self, postings: int) -> ReplyIndex:
        return replace(self, max_broadcast=postings)


def add_exemplars(
    messages: DataFrame, text: str, index: ReplyIndex, k: int = 3, own: str | None = None, out: str = "exemplars"
) -> DataFrame:
    """Append ``out``: array of (kb_id, score), best first, scores above 0 only.

    Ties (equal to nine places) go to the smaller kb_id. ``own`` names a column
    whose value is a reply the message must not find, such as its own thread.
    """
    if index.vectors is None:
        return messages.withColumn(out, F.array().cast("array<struct<kb_id:bigint,score:double>>"))
    with_vec = index.model.transform(messages, text, "_vec")
    own_id = F.lit(None).cast("long") if own is None else F.col(own)
    if index.fits_broadcast:
        score = _scorer(index, k)
        # as text, since pandas would make floats of whole numbers with gaps
        hits = with_vec.withColumn("_hits", score(F.col("_vec.idx"), F.col("_vec.w"), own_id.cast("string")))
        pairs = F.arrays_zip(F.col("_hits.kb_id").alias("kb_id"), F.col("_hits.score").alias("score"))
        return hits.withColumn(out, pairs.cast("array<struct<kb_id:bigint,score:double>>")).drop("_vec", "_hits")
    # equal messages are one question; the digest stands for the text, and nulls are left out of the JSON
    question = F.to_json(F.struct(F.col(text).cast("string").alias("text"), own_id.cast("string").alias("own")))
    # a message without a known word asks nothing; a key of its own keeps such messages from meeting
    asks = F.coalesce(F.size("_vec.idx") > 0, F.lit(False))
    alone = F.unhex(F.hex(F.monotonically_increasing_id()))
    asked = with_vec.withColumn("_ask", F.when(asks, F.unhex(F.sha2(question, 256))).otherwise(alone))
    return _joined(asked.withColumn("_own", own_id), index, k, out).drop("_vec", "_own", "_ask")


# ---------------------------------------------------------------- small table: score in place


def _scorer(index: ReplyIndex, k: int):
    """Arrow UDF over (idx, w, own id); the postings arrive once per executor."""
    shared = index.shared_postings

    @F.pandas_udf(HITS)
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        kb_ids, start, place, weight = shared.value
        sums = _Sums(kb_ids, start, place, weight)
        for idx, w, own in batches:
            alone = lambda i, x, o: _best(i, x, o, kb_ids, start, place, weight, k)
            found = sums.best([i if i is not None else () for i in idx], list(w), list(own), k, alone)
            yield pd.DataFrame({"kb_id": [f[0] for f in found], "score": [f[1] for f in found]})

    # keeps the optimizer from moving the call into a generator, where Python cannot run, or from repeating it
    return score.asNondeterministic()


def _best(idx, w, own, kb_ids, start, place, weight, k: int) -> tuple[list, list]:
    """Best ``k`` rows of one message by summing the postings of its terms."""
    if idx is None or len(idx) == 0:
        return [], []
    at = np.concatenate([place[start[t] : start[t + 1]] for t in idx])
    parts = np.concatenate([weight[start[t] : start[t + 1]] * x for t, x in zip(idx, w)])
    if DENSE * len(at) >= len(kb_ids):  # a sum for every reply costs less than sorting the postings
        scores = np.bincount(at, parts, len(kb_ids))
        hit = np.flatnonzero(scores)
        scores = scores[hit]
    else:  # only replies that share a term are touched
        hit, where = np.unique(at, return_inverse=True)
        scores = np.bincount(where, parts, len(hit))
    keep = scores != 0
    if own is not None:
        keep &= kb_ids[hit] != int(own)
    hit, scores = hit[keep], scores[keep]
    rounded = np.round(scores, _PLACES)
    if len(hit) > 8 * k:
        floor = np.partition(rounded, len(hit) - k)[len(hit) - k]
        near = rounded >= floor
        hit, scores, rounded = hit[near], scores[near], rounded[near]
    best = np.argsort(-rounded, kind="stable")[:k]
    return kb_ids[hit[best]].tolist(), scores[best].tolist()


class _Sums:
    """Scores of messages that touch many replies, some messages at a time.

    Postings of the most common terms are a matrix in single precision, so a batch of messages is one product; the
    other postings are added to it. A reply that is farther than the possible error below the k best sums is none of
    the best, and the few others are scored in double precision, term by term in their order as :func:`_best` does.
    """

    def __init__(self, kb_ids: np.ndarray, start: np.ndarray, place: np.ndarray, weight: np.ndarray):
        self.ids, self.start, self.place, self.weight = kb_ids, start, place, weight
        self.sizes = np.diff(start)
        self.made = False

    def _make(self) -> None:
        replies, terms = len(self.ids), len(self.sizes)
        often = np.argsort(-self.sizes, kind="stable")[: CELLS // replies]
        often = often[self.sizes[often] * COMMON >= replies]
        self.row = np.full(terms, -1)
        self.row[often] = np.arange(len(often))
        # a multiple of RUN
        self.summed = np.zeros((len(often), -(-replies // RUN) * RUN), np.float32)
        for i, t in enumerate(often):
            own = slice(self.start[t], self.start[t + 1])
            self.summed[i, self.place[own]] = self.weight[own]
        # postings by reply, in order of their terms
        order = np.argsort(self.place, kind="stable")
        self.term, self.of_term = np.repeat(np.arange(terms, dtype=np.int32), self.sizes)[order], self.weight[order]
        self.begin = np.searchsorted(self.place[order], np.arange(replies + 1))
        self.light = self.weight.astype(np.float32)
        self.made = True

    def best(self, idx: list, w: list, own: list, k: int, alone) -> list[tuple[list, list]]:
        """As :func:`_best` for each message; ``alone`` is asked for those that touch few replies."""
        idx, w = [np.asarray(i, np.int64) for i in idx], [np.asarray(x, np.float64) for x in w]
        found: list = [None] * len(idx)
        many = []
        for m, i in enumerate(idx):
            known = i < len(self.sizes)
            touched = self.sizes[i[known]].sum() if len(i) else 0
            if len(self.ids) > RUN * k and TOGETHER * touched >= len(self.ids):
                idx[m], w[m] = i[known], w[m][known]
                many.append(m)
            else:
                found[m] = alone(i, w[m], own[m])
        if many and not self.made:
            self._make()
        step = min(MESSAGES_AT_ONCE, max(1, CELLS // max(1, len(self.ids))))
        for at in range(0, len(many), step):
            part = many[at : at + step]
            asked = np.zeros((len(part), len(self.summed)), np.float32)
            for n, m in enumerate(part):
                row = self.row[idx[m]]
                asked[n, row[row >= 0]] = w[m][row >= 0]
            sums = asked @ self.summed
            for n, m in enumerate(part):
                found[m] = self._best(idx[m], w[m], own[m], sums[n], k)
        return found

    def _best(self, idx: np.ndarray, w: np.ndarray, own, sums: np.ndarray, k: int) -> tuple[list, list]:
        rest = self.row[idx] < 0
        for t, x in zip(idx[rest].tolist(), w[rest].astype(np.float32)):
            own_run = slice(self.start[t], self.start[t + 1])
            sums[self.place[own_run]] += self.light[own_run] * x
        if own is not None:
            sums[np.searchsorted(self.ids, int(own)) : np.searchsorted(self.ids, int(own), "right")] = 0
        # each of RUN replies here and there has a best one; k of these reach the floor, so no reply far below it is needed
        tops = sums.reshape(RUN, -1).max(axis=0)
        floor = np.partition(tops, len(tops) - k)[len(tops) - k]
        hit = np.flatnonzero(sums >= max(floor - _SLACK, np.finfo(np.float32).tiny))
        sizes = self.begin[hit + 1] - self.begin[hit]
        owner = np.repeat(np.arange(len(hit)), sizes)
        at = np.arange(len(owner)) + np.repeat(self.begin[hit] - (np.cumsum(sizes) - sizes), sizes)
        asked = np.zeros(len(self.sizes))
        asked[idx] = w
        scores = np.bincount(owner, asked[self.term[at]] * self.of_term[at], len(hit))
        first = np.argsort(-np.round(scores, _PLACES), kind="stable")[:k]
        return self.ids[hit[first]].tolist(), scores[first].tolist()


# ---------------------------------------------------------------- large table: join on terms


class _Block:
    """Postings of some replies by term, in order of kb_id, with the largest and the k-th largest weight of each term."""

    def __init__(self, replies: pa.Table, k: int):
        replies = replies.sort_by("kb_id").combine_chunks()
        self.ids = replies.column("kb_id").to_numpy()
        terms, weights, owner = _flat(replies)
        order = np.argsort(terms, kind="stable")
        self.place, self.weight = owner[order], weights[order]
        self.start = np.searchsorted(terms[order], np.arange(terms.max(initial=-1) + 2))
        self.top, self.kth = np.zeros(len(self.start) - 1), np.zeros(len(self.start) - 1)
        for t in np.flatnonzero(np.diff(self.start)):
            held = self.weight[self.start[t] : self.start[t + 1]]
            self.top[t] = held.max()
            # one more than k, as a message may have to skip its own thread
            self.kth[t] = np.partition(held, len(held) - k - 1)[len(held) - k - 1] if len(held) > k else 0.0

    def best(self, idx: np.ndarray, w: np.ndarray, own: int | None, k: int) -> tuple[list, list]:
        """As :func:`_best`, without the terms that cannot lift a reply of this block into its top ``k``."""
        known = idx < len(self.top)
        idx, w = idx[known], w[known]
        most = w * self.top[idx]
        rising = np.argsort(most, kind="stable")
        added = np.cumsum(most[rising])
        skipped = rising[: np.searchsorted(added, (w * self.kth[idx]).max(initial=0.0) - _MARGIN)]
        if len(skipped) == 0:
            return _best(idx, w, own, self.ids, self.start, self.place, self.weight, k)
        need = np.setdiff1d(np.arange(len(idx)), skipped)
        runs = [slice(self.start[t], self.start[t + 1]) for t in idx[need]]
        at = np.concatenate([self.place[r] for r in runs])
        sums = np.bincount(at, np.concatenate([self.weight[r] * x for r, x in zip(runs, w[need])]), len(self.ids))
        hit = np.flatnonzero(sums)
        if own is not None:
            hit = hit[self.ids[hit] != own]
        part = sums[hit]
        # k replies reach at least the k-th part score; what cannot reach it with the skipped terms is out
        if len(part) > k:
            close = part + most[skipped].sum() >= np.partition(part, len(part) - k)[len(part) - k] - _MARGIN
            hit, part = hit[close], part[close]
        for j in skipped:
            low, high = self.start[idx[j]], self.start[idx[j] + 1]
            if low < high:
                found = np.minimum(np.searchsorted(self.place[low:high], hit), high - low - 1)
                part += np.where(self.place[low + found] == hit, self.weight[low + found] * w[j], 0.0)
        first = np.argsort(-np.round(part, _PLACES), kind="stable")[:k]
        return self.ids[hit[first]].tolist(), part[first].tolist()


def _flat(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, weights and the row of each."""
    idx, w = (rows.column(c).combine_chunks() for c in ("idx", "w"))
    sizes = idx.value_lengths().to_numpy(zero_copy_only=False)
    return idx.flatten().to_numpy(), w.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)


def _joined(messages: DataFrame, index: ReplyIndex, k: int, out: str) -> DataFrame:
    """Slices of questions meet blocks of postings; a task joins one slice and one block on terms and returns top k's.

    The pairs of a question and a reply that share a term are many times the
    input; they are added up where they meet and are never shuffled.
    """
    blocks = -(-index.postings // POSTINGS_PER_PIECE)
    slices = messages.count() // QUESTIONS_PER_SLICE + 1

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(sides: DataFrame) -> DataFrame:
        """A pair of slice and block is one task: by a hash several of them would meet in one."""
        cell = (F.col("slice") * blocks + F.col("block")).cast("int").alias("cell")
        return sides.select(cell, *[c for c in sides.columns if c not in ("slice", "block")]).repartitionById(slices * blocks, F.col("cell"))

    asked = messages.where(F.size("_vec.idx") > 0).select(
        F.pmod(F.xxhash64("_ask"), F.lit(slices)).cast("int").alias("slice"), "_ask", "_own", "_vec.idx", "_vec.w", numbers(blocks).alias("block")
    )
    replies = index.vectors.select(
        F.pmod(F.xxhash64("kb_id"), F.lit(blocks)).cast("int").alias("block"), "kb_id", "vec.idx", "vec.w", numbers(slices).alias("slice")
    )

    def score(questions: pa.Table, held: pa.Table) -> pa.Table:
        asks, found = [], []
        if questions.num_rows and held.num_rows:
            block = _Block(held, k)
            questions = questions.combine_chunks()
            terms, weights, owner = _flat(questions)
            ends = np.searchsorted(owner, np.arange(questions.num_rows + 1))
            # equal messages lie in one slice
            once = dict(zip(reversed(questions.column("_ask").to_pylist()), range(questions.num_rows - 1, -1, -1)))
            asks, own = list(once), questions.column("_own").take(pa.array(list(once.values()), pa.int64())).to_pylist()
            parts = [slice(ends[i], ends[i + 1]) for i in once.values()]
            sums = _Sums(block.ids, block.start, block.place, block.weight)
            best = sums.best([terms[p] for p in parts], [weights[p] for p in parts], own, k, lambda i, x, o: block.best(i, x, o, k))
            found = [[{"kb_id": a, "score": b} for a, b in zip(*pairs)] for pairs in best]
        pairs = pa.list_(pa.struct([("kb_id", pa.int64()), ("score", pa.float64())]))
        return pa.table({"_ask": pa.array(asks, pa.binary()), "_hits": pa.array(found, pairs)})

    met = dealt(asked).groupBy("cell").cogroup(dealt(replies).groupBy("cell"))
    hits = met.applyInArrow(score, "_ask binary, _hits array<struct<kb_id:bigint,score:double>>")
    # k entries of each block
    ranked = F.sort_array(
        F.transform(
            F.flatten(F.collect_list("_hits")),
            lambda x: F.struct((-F.round(x["score"], _PLACES)).alias("down"), x["kb_id"].alias("kb_id"), x["score"].alias("score")),
        )
    )
    best = hits.groupBy("_ask").agg(F.slice(ranked, 1, k).alias("_best"))
    found = F.transform(F.col("_best"), lambda x: F.struct(x["kb_id"].alias("kb_id"), x["score"].alias("score")))
    empty = F.array().cast("array<struct<kb_id:bigint,score:double>>")
    return messages.join(best, "_ask", "left").withColumn(out, F.coalesce(found, empty)).drop("_best")
