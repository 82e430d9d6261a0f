"""Toxicity by a linear-chain conditional random field with two states, clean and toxic, over the words of a text.

Labels come for whole documents; token labels are made from them: greedily, the word or word beginning that marks
most of the still unexplained toxic documents and hardly any clean one is taken, until too few are left. A word of a
toxic document that has such a mark is labelled toxic, every other word clean. The CRF (hashed features of a word and
its beginnings, 2 x 2 transitions) is trained on these labels by gradient ascent on the conditional likelihood; its
expectations come from forward-backward sums. A document's score is a logistic function of the largest marginal and
of their sum, fitted on the document labels. Words with a marginal of one half or more are joined to offending spans.

Training uses a bounded sample (TRAIN_TOXIC and TRAIN_CLEAN documents, those of smallest hash, at most TRAIN_BYTES of
text); scoring runs over all of every text. Long texts are no loop of their own: words are put in blocks, block
transfer matrices are multiplied for all blocks at once, and only these are chained along a text.

Defined cases: null and empty texts have no words and the score of the fitted intercept; without any label of one
kind every score is 0; of the rows of one doc_id the shortest text is trained on; a labelled text that doesn't fit in what
is left of TRAIN_BYTES is passed over, or cut to half of it if its kind of label would be missing otherwise; repeated rows get equal scores; extra columns are ignored; a doc_id may be null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, RangeHash, slices, text_bytes, trim, trimmed, words_of

TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_BYTES = 1600, 3200, 12 << 20
#: A mark stands in at least so many training documents that nothing else explains ...
SUPPORT = 3
#: ... and is so many times as frequent in toxic documents as in clean ones.
LIFT = 20.0
BEGINNINGS = (3, 4, 5, 6, 8)
BITS = 20
CHUNK, BLOCK, STEPS = 32, 64, 40
#: Chunks of CHUNK words on which the CRF is trained, drawn from the training documents.
TOXIC_CHUNKS, CLEAN_CHUNKS = 1500, 2500
SEED = 5

def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashed features (a row a word): its beginnings and the word itself; 0 stands for none."""
    hashes = RangeHash(LOWER[data])
    out = np.zeros((len(start), len(BEGINNINGS) + 1), np.int32)
    for k, n in enumerate(BEGINNINGS):
        long = end - start > n
        out[long, k] = (hashes(start[long], start[long] + n) >> np.uint64(64 - BITS)).astype(np.int32) | 1
    out[:, -1] = ((hashes(start, end) ^ np.uint64(0xABCDEF)) >> np.uint64(64 - BITS)).astype(np.int32) | 1
    return out


def _product(a, b):
    """Products of 2 x 2 matrices as (n, 4), each scaled by its sum."""
    c = np.stack((a[:, 0] * b[:, 0] + a[:, 1] * b[:, 2], a[:, 0] * b[:, 1] + a[:, 1] * b[:, 3], a[:, 2] * b[:, 0] + a[:, 3] * b[:, 2], a[:, 2] * b[:, 1] + a[:, 3] * b[:, 3]), 1)
    return c / (c[:, :1] + c[:, 1:2] + c[:, 2:3] + c[:, 3:])


def marginals(unary: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """P(toxic) of each word given its whole text. unary: scores of all words, text after text; lengths: words each."""
    if not len(unary):
        return np.zeros(0)
    blocks = -(-lengths // BLOCK)
    first = np.cumsum(blocks) - blocks  # of a text
    starts = np.cumsum(lengths) - lengths
    word_text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(unary)) - starts[word_text]
    row, col = first[word_text] + place // BLOCK, place % BLOCK
    n = int(blocks.sum())
    u = np.zeros((n, BLOCK))
    real = np.zeros((n, BLOCK), bool)
    u[row, col], real[row, col] = np.exp(np.clip(unary, -30, 30)), True
    e = np.exp(trans)
    step = lambda t: np.where(real[:, t, None], np.stack((np.full(n, e[0, 0]), e[0, 1] * u[:, t], np.full(n, e[1, 0]), e[1, 1] * u[:, t]), 1), np.array([1.0, 0, 0, 1]))
    total = step(0)
    for t in range(1, BLOCK):
        total = _product(total, step(t))
    # Messages at block borders, texts side by side.
    forward, backward = np.zeros((n, 2)), np.ones((n, 2))
    texts = np.flatnonzero(blocks)
    forward[first[texts]] = (1.0, 0.0)  # before the first word: clean
    k = 1
    while len(alive := np.flatnonzero(blocks > k)):
        f, m = forward[first[alive] + k - 1], total[first[alive] + k - 1]
        g = np.stack((f[:, 0] * m[:, 0] + f[:, 1] * m[:, 2], f[:, 0] * m[:, 1] + f[:, 1] * m[:, 3]), 1)
        forward[first[alive] + k] = g / g.sum(1, keepdims=True)
        last = first[alive] + blocks[alive] - k  # from the end
        b, m = backward[last], total[last]
        g = np.stack((m[:, 0] * b[:, 0] + m[:, 1] * b[:, 1], m[:, 2] * b[:, 0] + m[:, 3] * b[:, 1]), 1)
        backward[last - 1] = g / g.sum(1, keepdims=True)
        k += 1
    alpha = np.empty((n, BLOCK, 2))
    f = forward
    for t in range(BLOCK):
        m = step(t)
        f = np.stack((f[:, 0] * m[:, 0] + f[:, 1] * m[:, 2], f[:, 0] * m[:, 1] + f[:, 1] * m[:, 3]), 1)
        f /= f[:, :1] + f[:, 1:]
        alpha[:, t] = f
    out = np.empty((n, BLOCK))
    b = backward
    for t in range(BLOCK - 1, -1, -1):
        both = alpha[:, t] * b
        out[:, t] = both[:, 1] / (both[:, 0] + both[:, 1])
        m = step(t)
        b = np.stack((m[:, 0] * b[:, 0] + m[:, 1] * b[:, 1], m[:, 2] * b[:, 0] + m[:, 3] * b[:, 1]), 1)
        b /= b[:, :1] + b[:, 1:]
    return out[row, col]


def token_marks(feats: np.ndarray, doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The features that mark toxic documents, by greedy cover."""
    n_tox, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    size = 1 << BITS
    cuts = np.searchsorted(doc, np.arange(0, len(toxic) + 100, 100))  # a hundred documents at a time, for memory

    def pairs():
        for a, b in zip(cuts, cuts[1:]):
            found = np.unique((doc[a:b].astype(np.int64)[:, None] << BITS) | feats[a:b])
            found = found[(found & (size - 1)) > 0]
            yield (found >> BITS).astype(np.int32), (found & (size - 1)).astype(np.int32)

    in_tox, in_clean = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for of, f in pairs():
        np.add.at(in_tox, f[toxic[of]], 1)
        np.add.at(in_clean, f[~toxic[of]], 1)
    lift = (in_tox / n_tox) / ((in_clean + 0.5) / n_clean)
    good = (in_tox >= SUPPORT) & (lift >= LIFT)
    of, f = (np.concatenate(x) for x in zip(*[(of[k], f[k]) for of, f in pairs() for k in [good[f] & toxic[of]]]))
    names, f = np.unique(f, return_inverse=True)
    weight = np.log(lift[names])
    left, marks = np.ones(len(toxic), bool), []
    while len(names):
        gain = np.bincount(f[left[of]], minlength=len(names))
        best = int(np.argmax(gain * weight))
        if gain[best] < SUPPORT:
            break
        marks.append(names[best])
        left[of[f == best]] = False
    return np.array(marks, np.int64)


def train(texts: pa.Array, toxic: np.ndarray) -> dict:
    """weights (hashed), trans (2 x 2), head (3 numbers): all that scoring needs. Runs in the driver: what is large is made
    from slices of the texts, so that beside the features only a slice's hashes and marginals are held."""
    feats, lengths = zip(*map(_words, slices(pa.record_batch([texts], ["text"]), 0)))
    cuts = np.cumsum([0, *map(len, lengths)])  # of the slices, in texts
    feats, lengths = np.concatenate(feats), np.concatenate(lengths)
    ends = np.concatenate(([0], np.cumsum(lengths)))
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    marked = np.zeros(1 << BITS, bool)
    marked[token_marks(feats, doc, toxic)] = True
    y = (marked[feats].any(1) & toxic[doc]).astype(np.int8)
    # Chunks of CHUNK words: all that have a toxic word, and others as a sample of clean context.
    place = ((np.arange(len(doc)) - ends[doc]) % CHUNK).astype(np.int8)
    chunk = np.cumsum(place == 0, dtype=np.int32) - 1
    hit = np.bincount(chunk, weights=y) > 0
    random = np.random.default_rng(SEED)
    use = np.zeros(len(hit), bool)
    for kind, most in ((hit, TOXIC_CHUNKS), (~hit, CLEAN_CHUNKS)):
        use[random.permutation(np.flatnonzero(kind))[:most]] = True
    rows = np.flatnonzero(use[chunk])
    _, r = np.unique(chunk[rows], return_inverse=True)
    n, c = int(r.max()) + 1 if len(r) else 0, place[rows]
    x = np.zeros((n, CHUNK, feats.shape[1]), np.int32)
    lab, real = np.zeros((n, CHUNK), np.int8), np.zeros((n, CHUNK), bool)
    x[r, c], lab[r, c], real[r, c] = feats[rows], y[rows], True
    w, trans = np.zeros(1 << BITS), np.array([[0.0, -2.0], [0.0, -1.0]])
    g2, t2 = np.full(1 << BITS, 1e-3), np.full((2, 2), 1e-1)
    flat = x[real]
    prev = np.concatenate((np.zeros((n, 1), np.int8), lab[:, :-1]), 1)
    seen = np.zeros((2, 2))
    np.add.at(seen, (prev[real], lab[real]), 1)
    for _ in range(STEPS if n else 0):
        u = np.zeros((n, CHUNK))
        u[real] = w[flat].sum(1)
        p, pair = _expectations(u, trans, real)
        grad = np.bincount(flat.ravel(), weights=np.repeat(lab[real] - p[real], flat.shape[1]), minlength=1 << BITS) - 0.02 * w
        grad[0] = 0
        g2 += grad**2
        w += 0.5 * grad / np.sqrt(g2)
        tgrad = seen - pair - 0.1 * trans
        t2 += tgrad**2
        trans += 0.3 * tgrad / np.sqrt(t2)
    w[0] = 0
    model = {"weights": w.astype(np.float32), "trans": trans, "head": np.zeros(3)}
    parts = [summaries(w[feats[ends[a] : ends[b]]].sum(1), trans, doc[ends[a] : ends[b]] - np.int32(a), lengths[a:b])[0] for a, b in zip(cuts, cuts[1:])]
    model["head"] = _logistic(np.concatenate(parts), toxic)
    return model


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Features of all words of some texts, and how many words each text has."""
    data, offsets = text_bytes(part.column(0))
    start, end, doc = words_of(data, offsets)
    return features(data, start, end), np.bincount(doc, minlength=part.num_rows)


def _expectations(u: np.ndarray, trans: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each word of padded chunks, and expected transitions."""
    n, length = u.shape
    e, v = np.exp(trans), np.exp(np.clip(u, -30, 30))
    alpha, beta = np.zeros((n, length + 1, 2)), np.ones((n, length + 1, 2))
    alpha[:, 0] = (1.0, 0.0)
    for t in range(length):
        f = alpha[:, t] @ e
        f[:, 1] *= v[:, t]
        f = np.where(real[:, t, None], f, alpha[:, t])
        alpha[:, t + 1] = f / (f[:, :1] + f[:, 1:])
    pair = np.zeros((2, 2))
    for t in range(length - 1, -1, -1):
        ahead = beta[:, t + 1] * np.stack((np.ones(n), v[:, t]), 1)
        joint = alpha[:, t, :, None] * e[None] * ahead[:, None, :]
        joint = joint.reshape(n, 4)[real[:, t]]
        pair += (joint / (joint[:, :1] + joint[:, 1:2] + joint[:, 2:3] + joint[:, 3:])).sum(0).reshape(2, 2)
        b = ahead @ e.T
        b = np.where(real[:, t, None], b, beta[:, t + 1])
        beta[:, t] = b / (b[:, :1] + b[:, 1:])
    both = alpha[:, 1:] * beta[:, 1:]
    return both[..., 1] / (both[..., 0] + both[..., 1]), pair


def summaries(unary: np.ndarray, trans: np.ndarray, doc: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the largest marginal and log(1 + their sum); and the marginals."""
    p = marginals(unary, trans, lengths)
    top = np.zeros(len(lengths))
    np.maximum.at(top, doc, p)
    return np.stack((top, np.log1p(np.bincount(doc, weights=p, minlength=len(lengths)))), 1), p


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and two slopes, by Newton steps with a small penalty."""
    x1, b = np.column_stack((np.ones(len(x)), x)), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ b, -30, 30)))
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + 1e-2 * np.eye(3)
        b += np.linalg.solve(h, x1.T @ (y - p) - 1e-2 * b)
    return b


def score_texts(texts: pa.Array, model: dict) -> tuple[np.ndarray, list]:
    """Score of each text, and its spans: lists of (start, end) in bytes."""
    data, offsets = text_bytes(texts)
    start, end, doc = words_of(data, offsets)
    lengths = np.bincount(doc, minlength=len(texts))
    x, p = summaries(model["weights"][features(data, start, end)].sum(1, dtype=np.float64), model["trans"], doc, lengths)
    h = model["head"]
    score = 1 / (1 + np.exp(-np.clip(h[0] + x @ h[1:], -30, 30)))
    hit = np.flatnonzero(p >= 0.5)
    spans: list = [[] for _ in range(len(texts))]
    joined = -2
    for i in hit.tolist():
        d, s, e = int(doc[i]), int(start[i] - offsets[doc[i]]), int(end[i] - offsets[doc[i]])
        if i == joined + 1 and spans[d]:
            spans[d][-1] = (spans[d][-1][0], e)
        else:
            spans[d].append((s, e))
        joined = i
    return score, spans


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _fitting(order, size: np.ndarray) -> list[int]:
    take, held = [], 0
    for i in order:
        if held + size[i] <= TRAIN_BYTES:
            take.append(i)
            held += size[i]
    return take


def drawn(size: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents that fit in TRAIN_BYTES, in random order, and how much of each is taken: all, unless a kind of label
    would be missing; then the shortest document of each kind comes first, with half of the room at most."""
    order = np.random.default_rng(SEED).permutation(len(size)).tolist()
    take, most = _fitting(order, size), size
    if len(np.unique(toxic[take])) < len(np.unique(toxic)):
        first = [int(k[np.argmin(size[k])]) for k in (np.flatnonzero(toxic), np.flatnonzero(~toxic)) if len(k)]
        most = size.copy()
        most[first] = np.minimum(size[first], TRAIN_BYTES // 2)
        take = _fitting(first + [i for i in order if i not in first], most)
    take = np.sort(np.array(take, np.int64))
    return take, most[take]


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The model from labelled documents outside the held-out fold; None without both kinds of label."""
    known = labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").alias("l_toxic")).filter(F.col("l_toxic").isNotNull() & F.col("l_id").isNotNull() & ~held_out(F.col("l_id"))).groupBy("l_id").agg(F.max("l_toxic").alias("l_toxic"))
    # The sample is drawn on the label table alone; only its documents' texts are fetched.
    rank = F.xxhash64(F.lit(SEED), "l_id")
    chosen = known.filter("l_toxic = 1").orderBy(rank, "l_id").limit(TRAIN_TOXIC).unionByName(known.filter("l_toxic = 0").orderBy(rank, "l_id").limit(TRAIN_CLEAN))
    # Sizes first, then no more text than is trained on. Of rows of one doc_id the shortest text speaks.
    labelled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    found = labelled.groupBy("doc_id").agg(F.min(F.struct(F.length("text").alias("size"), F.xxhash64("text").alias("key"), F.col("l_toxic").alias("toxic"))).alias("least")).select("doc_id", "least.*").toArrow().sort_by("doc_id")
    size, toxic = np.array(found["size"], np.int64), np.array(found["toxic"].to_pylist(), bool)
    take, most = drawn(size, toxic)
    if not toxic[take].any() or toxic[take].all():
        return None
    asked = docs.sparkSession.createDataFrame(list(zip(np.array(found["doc_id"])[take].tolist(), np.array(found["key"])[take].tolist(), most.tolist(), toxic[take].tolist())), "t_id bigint, t_key bigint, most bigint, t_toxic boolean")
    same = (F.col("doc_id") == F.col("t_id")) & (F.xxhash64("text") == F.col("t_key"))
    table = labelled.join(F.broadcast(asked), same).select("doc_id", F.expr("substring(text, 1, int(most))").alias("text"), "t_toxic").dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    texts, toxic = pa.concat_arrays(table["text"].chunks), np.array(table["t_toxic"].to_pylist(), bool)
    del table, found
    try:
        return train(texts, toxic)
    finally:
        trim()


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and spans (array of start and end in UTF-8 bytes) of every document."""
    model = fit(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB, whatever the input

    def run(batches):
        m = sent.value
        for batch in batches:
            for part in slices(batch, 1):
                s, spans = (np.zeros(part.num_rows), [[]] * part.num_rows) if m is None else score_texts(part.column(1), m)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id bigint, score double, spans array<struct<start: bigint, end: bigint>>")
