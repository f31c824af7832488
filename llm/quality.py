"""Document quality by a byte-level convolutional network in numpy.

A document's bytes are embedded and passed through learned filters. Responses are
max-pooled over overlapping chunks (two neighbouring segments each) that cover the whole
text; a small layer combines the maximum, mean and minimum over the chunks, and the length
of the text, into one probability. Training runs
on a bounded sample of labelled rows, scoring on every text in full.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.frames import mapped
from llm.words import slices, utf8

#: Bytes of a segment (a chunk is two, the step one), width and number of filters, embedding.
SEGMENT, WIDTH, FILTERS, EMBEDDING = 256, 8, 16, 4
#: Units of the combining layer, and what it takes: three numbers a filter, two of length.
HIDDEN, INPUTS = 16, 3 * FILTERS + 2
#: Labelled rows that training takes of each class, by hash order, and their bytes in all.
SAMPLE_ROWS, SAMPLE_BYTES = 1500, 10_000_000
#: Passes over the sample, or as many as make STEPS steps of the descent from a small one.
EPOCHS, STEPS, BATCH, RATE, SEED = 8, 400, 32, 0.01, 7
THRESHOLD = 0.3


def segments(data, offsets):
    """(n, SEGMENT + WIDTH - 1) bytes of each text's segments and where texts begin.

    Text ends are filled with the byte 0, whose embedding is zero; an empty text has one
    segment of them.
    """
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-sizes // SEGMENT))
    first = np.concatenate(([0], np.cumsum(counts)))
    text = np.repeat(np.arange(len(sizes)), counts)
    at = (np.arange(first[-1]) - first[text]) * SEGMENT
    places = at[:, None] + np.arange(SEGMENT + WIDTH - 1)
    inside = places < sizes[text][:, None]
    padded = np.append(data, np.uint8(0))
    bytes_ = padded[np.where(inside, places + offsets[:-1][text][:, None], len(data))]
    return np.where(inside, np.maximum(bytes_, 1), 0).astype(np.uint8), first


def start(seed=SEED):
    r = np.random.default_rng(seed)
    w = {"embed": r.normal(0, 0.5, (256, EMBEDDING)),
         "filters": r.normal(0, (WIDTH * EMBEDDING) ** -0.5, (WIDTH * EMBEDDING, FILTERS)),
         "bias": np.zeros(FILTERS), "combine": r.normal(0, INPUTS ** -0.5, (INPUTS, HIDDEN)),
         "hidden": np.zeros(HIDDEN), "out": r.normal(0, 0.1, HIDDEN), "shift": np.zeros(1)}
    w["embed"][0] = 0
    return {k: v.astype(np.float32) for k, v in w.items()}


def responses(w, block):
    """(n, SEGMENT, FILTERS) filter responses of n segments."""
    embedded = w["embed"][block]  # n, SEGMENT + WIDTH - 1, EMBEDDING
    n, length, size = embedded.shape
    windows = np.lib.stride_tricks.as_strided(
        embedded, (n, SEGMENT, WIDTH * size),
        (embedded.strides[0], embedded.strides[1], embedded.strides[2]))
    return (windows.reshape(n * SEGMENT, WIDTH * size) @ w["filters"]).reshape(n, SEGMENT, -1)


def pooled(w, parts, step=128):
    """Largest response of each filter in each segment."""
    return np.concatenate([responses(w, parts[i:i + step]).max(axis=1)
                           for i in range(0, len(parts), step)])


def _chunked(best, first):
    """Chunk maxima from segment maxima; which segment gave them; where texts begin."""
    counts = np.diff(first)
    last = np.zeros(len(best), dtype=bool)
    last[first[1:] - 1] = True
    begins = np.flatnonzero(~last | np.repeat(counts == 1, counts))
    following = np.where(last[begins], begins, np.minimum(begins + 1, len(best) - 1))
    later = best[following] > best[begins]
    value = np.where(later, best[following], best[begins])
    source = np.where(later, following[:, None], begins[:, None])
    return value, source, np.concatenate(([0], np.cumsum(np.maximum(1, counts - 1))))


def combined(w, best, first, sizes):
    """Each text's probability, with what the gradient needs."""
    value, source, start_of = _chunked(best, first)
    active = np.tanh(value + w["bias"])
    cuts, n = start_of[:-1], np.diff(start_of)[:, None]
    high = np.maximum.reduceat(active, cuts)
    low = np.minimum.reduceat(active, cuts)
    mean = np.add.reduceat(active, cuts) / n
    length = np.stack([np.log1p(sizes) / 8, np.minimum(sizes / (2 * SEGMENT), 1)], axis=1)
    features = np.hstack([high, mean, low, length.astype(np.float32)])
    hidden = np.tanh(features @ w["combine"] + w["hidden"])
    z = hidden @ w["out"] + w["shift"]
    return 1 / (1 + np.exp(-z)), (active, source, start_of, high, low, features, hidden)


def _gradient(w, parts, first, sizes, labels, weights):
    step, best, where = 128, [], []
    for i in range(0, len(parts), step):
        r = responses(w, parts[i:i + step])
        at = r.argmax(axis=1)
        where.append(at)
        best.append(np.take_along_axis(r, at[:, None, :], 1)[:, 0])
    best, where = np.concatenate(best), np.concatenate(where)
    p, (active, source, start_of, high, low, features, hidden) = combined(w, best, first, sizes)
    dz = ((p - labels) * weights / weights.sum()).astype(np.float32)
    dhidden = dz[:, None] * w["out"] * (1 - hidden ** 2)
    dfeature = (dhidden @ w["combine"].T)[:, :3 * FILTERS]
    counts = np.diff(start_of)
    text = np.repeat(np.arange(len(labels)), counts)
    d_high, d_mean, d_low = np.split(dfeature, 3, axis=1)
    # Neighbouring chunks share a segment, so the extreme one often stands there twice.
    is_high, is_low = (active == high[text]).astype(float), (active == low[text]).astype(float)
    is_high /= np.add.reduceat(is_high, start_of[:-1])[text]
    is_low /= np.add.reduceat(is_low, start_of[:-1])[text]
    dactive = d_mean[text] / counts[text][:, None] + is_high * d_high[text] + is_low * d_low[text]
    dvalue = dactive * (1 - active ** 2)
    dbest = np.zeros(best.shape, dtype=w["filters"].dtype)
    f = np.broadcast_to(np.arange(FILTERS), dvalue.shape)
    np.add.at(dbest, (source, f), dvalue)
    s, f = np.nonzero(dbest)
    amount = dbest[s, f]
    bytes_ = parts[s[:, None], where[s, f][:, None] + np.arange(WIDTH)]
    seen = w["embed"][bytes_].reshape(len(s), -1)
    dfilters = np.zeros_like(w["filters"].T)
    np.add.at(dfilters, f, amount[:, None] * seen)
    dembed = np.zeros_like(w["embed"])
    back = (amount[:, None] * w["filters"].T[f]).reshape(len(s), WIDTH, EMBEDDING)
    np.add.at(dembed, bytes_, back)
    dembed[0] = 0
    return {"embed": dembed, "filters": dfilters.T, "bias": dvalue.sum(axis=0),
            "combine": features.T @ dhidden + 1e-4 * w["combine"], "hidden": dhidden.sum(axis=0),
            "out": hidden.T @ dz + 1e-4 * w["out"], "shift": dz.sum(keepdims=True)}


def fit(texts, labels, weights, epochs=EPOCHS, seed=SEED):
    """Weights learned by Adam from texts (bytes), labels 0 or 1 and row weights."""
    w = start(seed)
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    labels, weights = np.asarray(labels, np.float32), np.asarray(weights, np.float32)
    share = float((labels * weights).sum() / weights.sum())
    w["shift"][0] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
    r, t = np.random.default_rng(seed), 0
    batches = -(-len(texts) // BATCH)
    epochs = max(epochs, -(-STEPS // batches))
    rounds = epochs * batches
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            own = order[i:i + BATCH]
            data = np.frombuffer(b"".join(texts[j] for j in own), dtype=np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(texts[j]) for j in own]))).astype(np.int64)
            parts, first = segments(data, offsets)
            t += 1
            rate = RATE * (1 - 0.9 * t / rounds)
            for k, g in _gradient(w, parts, first, np.diff(offsets), labels[own],
                                  weights[own]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                w[k] = (w[k] - rate * (mean[k] / (1 - 0.9 ** t))
                        / (np.sqrt(square[k] / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
    return w


def score_block(w, data, offsets):
    if len(offsets) < 2:
        return np.zeros(0)
    parts, first = segments(data, offsets)
    return combined(w, pooled(w, parts), first, np.diff(offsets))[0].astype(float)


def held_out(doc_id):
    """Rows that training never sees: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sampled(rows, size):
    """Ids of rows (class, order, id, bytes) within a budget that the classes share.

    A class is filled in its order; a text too long for what is left is passed over, and
    what a class doesn't use goes to the others.
    """
    classes = {}
    for value, *row in sorted(rows):
        classes.setdefault(value, []).append(row)
    kept = []
    smallest = sorted(classes.values(), key=lambda own: (sum(n for *_, n in own), own))
    for i, own in enumerate(smallest):
        left = share = size // (len(smallest) - i)
        for _, key, n in own:
            if n <= left:
                kept.append(key)
                left -= n
        size -= share - left
    return kept


def train(docs, labels, rows=SAMPLE_ROWS, size=SAMPLE_BYTES):
    """The network of a bounded sample of labelled rows.

    Of each class the first ``rows`` ids by hash, and of those as many as ``size`` bytes
    hold; their weights restore the share that the class has among all labels. Without
    labels the score is 0.5 throughout.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
                         & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    share = dict(known.groupBy("quality").count().collect())
    order = F.xxhash64("doc_id")
    chosen = None
    for value in sorted(share):
        some = known.where(F.col("quality") == value).orderBy(order, "doc_id").limit(rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    if chosen is None:
        return None
    # At most 2 * rows ids are broadcast.
    texts = docs.select("doc_id", F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")),
                                           "UTF-8").alias("text")) \
        .join(F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id") \
        .select("doc_id", "quality", "text", F.length("text").alias("size"))
    # One text of each id, however often it is repeated.
    one = texts.groupBy("doc_id", "quality").agg(F.min(F.struct(
        F.xxhash64("text").alias("order"), "text", "size")).alias("row"))
    sizes = one.select("doc_id", "quality", F.col("row.size").alias("size"),
                       order.alias("order")).collect()
    kept = sampled([(r["quality"], r["order"], r["doc_id"], r["size"]) for r in sizes], size)
    found = one.where(F.col("doc_id").isin(kept)).select("doc_id", "quality", "row.text").collect()
    found = sorted((i, q, bytes(t)) for i, q, t in found)
    if not found:
        return None
    number = {q: sum(x == q for _, x, _ in found) for q in share}
    weights = [share[q] / number[q] for _, q, _ in found]
    return fit([t for _, _, t in found], [q for _, q, _ in found], weights)


_OUT = "doc_id long, score double"


def _scored(shared):
    def score(batches):
        w = shared.value
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                data, offsets = utf8(batch.column("text"))
                p = score_block(w, data, offsets) if w else np.full(batch.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])
    return score


def score_quality(docs, network):
    """``doc_id, score`` for each row of ``docs(doc_id, text)``, its whole text read.

    Null text counts as empty, repeated rows and null ids stay as they are, other columns
    are left out; an empty table gives an empty result.
    """
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return mapped(pairs, _scored(shared), _OUT)


def _sifted(shared, threshold):
    def sift(batches):
        w = shared.value
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                if w:
                    p = score_block(w, *utf8(batch.column("text")))
                    batch = batch.filter(pa.array(p >= threshold))
                yield batch
    return sift


def sifted(docs, labels, threshold=THRESHOLD):
    """The rows of ``docs`` with all their columns, without those the network rejects.

    Without labels there is no network and every row stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return mapped(docs, _sifted(shared, threshold), docs.schema)


def judged(docs, labels, threshold=THRESHOLD):
    """The columns of op8."""
    return score_quality(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
