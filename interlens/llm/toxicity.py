"""Toxicity by maximum-scoring segments.

Tokens are words (letters and digits, capitals folded) and the leading bytes of
longer words, so inflected forms share evidence.  A token's score comes from its
log-odds between toxic and clean labelled texts, smoothed by a Dirichlet prior
with the corpus's own frequencies: s = log(1 - share + share * odds), the log
likelihood ratio of a passage in which ``share`` of the words are toxic ones.
Every other word scores log(1 - share) < 0.

A linear scan (Ruzzo and Tompa's) finds all maximal-scoring segments of a text.
Clean texts fix their extreme-value law: lambda solves E[exp(lambda s)] = 1 and K
is fitted to the number of chance segments.  The evidence of a document is the
most surprising of its r best segments together (the law of sums of segment
scores), so one strong passage and several weak ones both count, and a long text
does not look toxic by length.  A logistic curve turns evidence into a score.

Fitted on a bounded sample of labelled rows (at most ``max_rows``, lowest hash
of the id, exact copies counted once): two thirds fix the tokens, one third the
calibration.  Prior counts and scores cover every whole text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import crc_fold, id_text, release, stored, summed
from .quality_model import training_ids

PREFIXES = (4, 5, 6, 7, 8)
SHARES = (0.2, 0.1, 0.05, 0.02, 0.01)
_FILTER = 20
_PART = np.ones(256, bool)
for _c in (*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)):
    _PART[_c] = False


def folded(c: tv.Chunk) -> tv.Chunk:
    """A-Z and the two-byte Latin capitals in lower case."""
    data = tv.LOWER[c.data]
    if len(data):
        after = np.zeros(len(data), bool)
        after[1:] = data[:-1] == 0xC3
        up = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
        data[up] += 0x20
    return tv.Chunk(data, c.offsets, c.first)


def tokens(w: tv.Words):
    """(word, hash) for the words themselves and each prefix length."""
    yield np.arange(len(w.hash)), w.hash
    for size in PREFIXES:
        yield tv.prefix_hash(w, size)


@dataclass
class Lexicon:
    """Sorted token hashes with their log-odds."""
    token: np.ndarray
    odds: np.ndarray
    filter: np.ndarray = field(init=False)

    def __post_init__(self):
        self.filter = np.zeros(1 << _FILTER, bool)
        self.filter[self.token >> tv.U64(64 - _FILTER)] = True

    def find(self, w: tv.Words):
        """(word, entry) of every token of the lexicon."""
        words, entries = [], []
        for at, h in tokens(w):
            near = np.flatnonzero(self.filter[h >> tv.U64(64 - _FILTER)])
            if len(near) and len(self.token):
                i = np.minimum(np.searchsorted(self.token, h[near]), len(self.token) - 1)
                hit = self.token[i] == h[near]
                words.append(at[near][hit])
                entries.append(i[hit])
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(words), np.concatenate(entries)

    def best(self, w: tv.Words):
        """(word, entry): for each word with tokens here, the most toxic one."""
        at, entry = self.find(w)
        order = np.lexsort((self.odds[entry], at))
        at, entry = at[order], entry[order]
        last = np.append(at[1:] != at[:-1], True) if len(at) else np.zeros(0, bool)
        return at[last], entry[last]


def segments(at: np.ndarray, score: np.ndarray, n: int, other: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first word, last word) of a text of
    ``n`` words: ``score`` at the words ``at`` (ascending), ``other`` < 0 elsewhere.

    Every candidate keeps a link to the nearest earlier one that starts lower.
    Looking back follows links, and what a link skips is skipped for good: the
    scan is linear in the hits.
    """
    stack: list[tuple[float, float, int, int, int]] = []    # low, high, first, last, link
    cum, before = 0.0, -1
    for p, s in zip(at.tolist(), score.tolist()):
        cum += other * (p - before - 1)
        before = p
        low, first = cum, p
        cum += s
        if s <= 0:
            continue
        j = len(stack) - 1
        while j >= 0 and stack[j][0] >= low:
            j = stack[j][4]
        while j >= 0 and stack[j][1] < cum:
            low, _, first, _, link = stack[j]
            del stack[j:]
            j = link
        stack.append((low, cum, first, p, j))
    return [(high - low, a, b) for low, high, a, b, _ in stack]


@dataclass
class Model:
    lexicon: Lexicon
    score: np.ndarray = field(default_factory=lambda: np.zeros(0))
    other: float = -0.1
    lam: float = 1.0
    log_k: float = 0.0
    bias: float = 0.0
    slope: float = 0.0

    def evidence(self, found: list[tuple[float, int, int]], n: int) -> float:
        """-log of the smallest p-value of the r best segments, r = 1, 2, ..."""
        out, total = 0.0, 0.0
        for r, (s, _, _) in enumerate(sorted(found, reverse=True), 1):
            x = self.lam * s - self.log_k - math.log(max(n, 1))
            if r > 1 and x <= 0:
                break
            total += x
            if total > 0:
                e = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2)
                out = max(out, e)
        return out

    def of_hits(self, at: np.ndarray, entry: np.ndarray, n: int):
        found = segments(at, self.score[entry], n, self.other)
        return self.evidence(found, n), found

    def curve(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + self.slope * np.log1p(evidence))))

    @property
    def chance(self) -> float:
        """Segment score that a clean text of 1000 words passes once in a thousand."""
        return (math.log(1e3 / 1e-3) + self.log_k) / self.lam


def log_odds(y1, y0, prior, n1: float, n0: float, weight: float):
    """Log-odds of counts y1 of n1 against y0 of n0 with a Dirichlet prior
    of ``weight`` counts spread as ``prior``, and half a count each; and their
    z-scores."""
    a = 0.5 + weight * prior
    up = np.log((y1 + a) / (n1 + weight - y1 - a))
    down = np.log((y0 + a) / (n0 + weight - y0 - a))
    return up - down, (up - down) / np.sqrt(1 / (y1 + a) + 1 / (y0 + a))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Bias, slope and mean loss of a one-variable logistic fit (Newton)."""
    b = np.zeros(2)
    m = np.stack([np.ones(len(x)), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((m * w[:, None]).T @ m + ridge * np.eye(2), m.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-(m @ b))), 1e-9, 1 - 1e-9)
    return float(b[0]), float(b[1]), float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def calibrate(lexicon: Lexicon, rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Model:
    """Fit share, lambda, K and the curve to rows (label, words, hit words, entries)."""
    best = None
    y = np.array([r[0] for r in rows], float)
    clean = [r for r in rows if not r[0]]
    n_clean = sum(r[1] for r in clean)
    rate = np.bincount(np.concatenate([r[3] for r in clean] or [np.zeros(0, np.int64)]),
                       minlength=len(lexicon.token)) / max(n_clean, 1)
    for share in SHARES:
        m = Model(lexicon, np.log(1 - share + share * np.exp(np.minimum(lexicon.odds, 10))), math.log(1 - share))
        gain = lambda t: float((rate * np.exp(t * m.score)).sum() + (1 - rate.sum()) * math.exp(t * m.other) - 1)
        low, high = 1e-6, 1.0
        while gain(high) < 0 and high < 64:
            high *= 2
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if gain(mid) < 0 else (low, mid)
        m.lam = max(high, 0.05)
        floor = float(np.quantile(m.score, 0.25)) if len(m.score) else 1.0
        chance = sum(s >= floor for r in clean for s, _, _ in segments(r[2], m.score[r[3]], r[1], m.other))
        m.log_k = math.log((chance + 0.5) / max(n_clean, 1)) + m.lam * floor
        x = np.log1p([m.of_hits(r[2], r[3], r[1])[0] for r in rows])
        if len(rows) and 0 < y.sum() < len(y):
            m.bias, m.slope, loss = _logistic(x, y)
        else:
            m.bias, loss = math.log((y.sum() + 1) / (len(y) - y.sum() + 1)), 0.0
        if best is None or loss < best[0]:
            best = (loss, m)
    return best[1]


def _toxic_tokens(batches):
    """(token): one row for each distinct token of a document, and one of hash 0."""
    for batch in batches:
        for c in tv.chunks(batch.column(0)):
            c = folded(c)
            w = tv.words(c, separator=_PART)
            parts = [np.stack([w.doc[at].astype(np.uint64), h]) for at, h in tokens(w)]
            pairs = np.unique(np.concatenate(parts, 1), axis=1)
            token, n = np.unique(pairs[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])


def _document_counts(lexicon):
    """One row a task: documents that hold each token of the lexicon, and distinct
    tokens in all documents."""
    def run(batches):
        lex = lexicon.value
        count, total = np.zeros(len(lex.token), np.int64), 0
        for batch in batches:
            for c in tv.chunks(batch.column(0)):
                c = folded(c)
                w = tv.words(c, separator=_PART)
                at, entry = lex.find(w)
                pair = np.unique(w.doc[at] * np.int64(len(lex.token) + 1) + entry)
                count += np.bincount(pair % (len(lex.token) + 1), minlength=len(lex.token))[:len(lex.token)]
                # distinct words stand for the number of tokens: prefixes follow them
                total += len(tv.shingle_sets(w, c.n_docs, 1)[0]) * (1 + len(PREFIXES))
        yield pa.RecordBatch.from_arrays([pa.array([np.append(count, total).tobytes()], pa.binary())], ["count"])
    return run


def document_counts(texts: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, int]:
    """Documents that hold each token, and distinct tokens, over all texts."""
    sent = texts.sparkSession.sparkContext.broadcast(lexicon)
    out = summed(texts.select("text").mapInArrow(_document_counts(sent), "count binary"), len(lexicon.token) + 1)
    sent.unpersist()
    return out[:-1], int(out[-1])


def train(texts: DataFrame, labels: DataFrame, target: str, max_rows: int, least_z: float, least_odds: float,
          least_docs: int, weight: float, id_col: str = "doc_id") -> Model:
    spark = texts.sparkSession
    none = Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    sample = training_ids(labels, target, max_rows, id_col)
    rows = texts.join(F.broadcast(sample), "id").withColumn("h", F.xxhash64("text"))
    firsts = rows.groupBy("h").agg(F.min("id").alias("first")).select("first")
    sample = stored(rows.join(F.broadcast(firsts), rows.id == F.col("first"))  # at most max_rows rows
                    .dropDuplicates(["id"]).select("id", "text", "y", (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(3)) < 2)
                                                   .alias("fits")), "toxicity-sample")
    toxic, clean = sample.where("fits and y = 1"), sample.where("fits and y = 0")
    found = (toxic.select("text").mapInArrow(_toxic_tokens, "token long, n long").groupBy("token")
             .agg(F.sum("n").alias("n")).where(F.col("n") >= least_docs).orderBy("token").collect())
    if found:
        token, y1 = (np.array(v) for v in zip(*((r["token"], r["n"]) for r in found)))
        order = np.argsort(token.astype(np.int64).view(np.uint64))
        lex = Lexicon(token.astype(np.int64).view(np.uint64)[order], np.zeros(len(token)))
        y1 = y1[order]
        y0, n0 = document_counts(clean, lex)
        n1 = document_counts(toxic, none)[1]
        odds, z = log_odds(y1, y0, (y1 + y0) / max(n1 + n0, 1), n1, n0, weight)
        keep = (z >= least_z) & (odds >= least_odds)
        lex, y1, y0 = Lexicon(lex.token[keep], odds[keep]), y1[keep], y0[keep]
        corpus, total = document_counts(texts, lex)  # the prior: all documents
        odds, z = log_odds(y1, y0, corpus / max(total, 1), n1, n0, weight)
        keep = (z >= least_z) & (odds >= least_odds)
        lex = Lexicon(lex.token[keep], odds[keep])
    else:
        lex = none
    sent = spark.sparkContext.broadcast(lex)

    def hits(batches):
        for batch in batches:
            y = batch.column(1).to_pylist()
            for c in tv.chunks(batch.column(0)):
                w = tv.words(folded(c), separator=_PART)
                at, entry = sent.value.best(w)
                doc = w.doc[at]
                cut = np.searchsorted(doc, np.arange(c.n_docs + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array([y[c.first + i] for i in range(c.n_docs)], pa.int32()), pa.array(w.counts),
                    pa.array([(at[a:b] - w.first[i]).tolist() for i, (a, b) in enumerate(zip(cut, cut[1:]))], pa.list_(pa.int64())),
                    pa.array([entry[a:b].tolist() for a, b in zip(cut, cut[1:])], pa.list_(pa.int64()))], ["y", "n", "at", "entry"])

    held = (sample.where("not fits").select("text", "y").mapInArrow(hits, "y int, n long, at array<long>, entry array<long>")
            .orderBy("n", "y", "at").collect())
    release(sample)
    return calibrate(lex, [(r["y"], r["n"], np.array(r["at"], np.int64), np.array(r["entry"], np.int64)) for r in held])


def score(docs: DataFrame, labels: DataFrame, target: str = "toxic", threshold: float = 0.5, max_rows: int = 20_000,
          least_z: float = 3.0, least_odds: float = 1.5, least_docs: int = 3, weight: float = 100.0,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Toxicity of every document and its significant passages.

    Labels are learnt only from rows whose crc32(id as text) mod 5 is not 0.
    Returns one row per input row: doc_id, held_out, score (0 to 1), predicted
    (1 if score >= threshold), evidence, passages (struct of first and last word
    and score, of segments that chance gives a clean text of 1000 words once in
    a thousand texts).  Texts of any length are scanned whole, in time linear in
    their words.  Null and empty texts have no evidence.  Rows and labels
    without an id, and null labels, are left out; of an id labelled twice the
    larger label counts.  Without toxic labels no token is toxic and all scores
    are the share of toxic labels.  Empty table: empty result.  Extra columns
    are not read.
    """
    texts = id_text(docs, id_col, text_col)
    model = texts.sparkSession.sparkContext.broadcast(
        train(texts, labels, target, max_rows, least_z, least_odds, least_docs, weight, id_col))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        m = model.value
        for batch in batches:
            for c in tv.chunks(batch.column(1)):
                w = tv.words(folded(c), separator=_PART)
                at, entry = m.lexicon.best(w)
                cut = np.searchsorted(w.doc[at], np.arange(c.n_docs + 1))
                evidence, passages = np.zeros(c.n_docs), [[] for _ in range(c.n_docs)]
                for i in np.flatnonzero(np.diff(cut)):
                    a, b = cut[i], cut[i + 1]
                    evidence[i], found = m.of_hits(at[a:b] - w.first[i], entry[a:b], int(w.counts[i]))
                    passages[i] = [{"first": x, "last": y, "score": s} for s, x, y in found if s >= m.chance]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(c.first, c.n_docs), pa.array(m.curve(evidence)), pa.array(evidence),
                     pa.array(passages, kind)], ["doc_id", "score", "evidence", "passages"])

    scored = texts.mapInArrow(run, "doc_id long, score double, evidence double, "
                                   "passages array<struct<first: long, last: long, score: double>>")
    return scored.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence", "passages")
