"""Language-model scores: a small causal self-attention model on subword ids (operator 7).

The model. A text is its words, lower-cased (A-Z), then one end; words are cut into
subword ids with word ends. One attention head looks back over a window of CONTEXT
ids with learnt relative positions and predicts the next id's group, the class within
the group (the most frequent ids are classes of their own), and takes the id's share
of its class among the training ids. A word's probability under attention
is the product over its ids, times that of going on within the word after every id
but the last and of ending it there, times that of its spelling: 1 - VARIANT for the
spelling that the ids stand for, VARIANT / 4 ** bytes for any other (letters whose
case or form the vocabulary drops). Words that the vocabulary drops altogether have
one id of their own, STRAY. So the probabilities of all words and the end sum to 1
at most. A word counts with MIX of attention and the rest of the contract's smoothed
unigram model. Windows overlap: each scores its last STRIDE ids, with the ids before
them as context only, so every id is scored once; windows are batched, with a mask
that is causal and does not cross documents.

What is learnt. One pass over all training texts counts words by 64-bit hash and
subword ids, and keeps all their windows, up to SHARE neighbouring ones a row.
Classes, shares, chances of going on and the first output bias follow from the id
counts. The distinct rows are dealt by a hash of their ids into buckets of about
BUCKET windows; in each of ROUNDS rounds every bucket trains its own copy of the
attention weights by gradients on all its windows, and the copies are averaged, an
id's rows by how often a bucket has the id. So every training text has its part in
the weights, copies of a text once. Windows and buckets grow with the input; what
reaches the driver is one row an id. Counts of words that make up more than 1 / FREQUENT of all training words are
broadcast (there are at most FREQUENT of them); every other word meets its count in
a part of the hashes, so the vocabulary is nowhere held whole. Parts follow from the
size of the input (PART_BYTES). Between tasks, words and counts go as arrays in few
rows: a pack of about PACK rare words asks every part for the counts of its words, and
the answers come back to it in the order of the questions.

Defined results: a null or empty text is the end alone; texts are read whole, in
windows of bounded size; repeated rows are scored row by row; rows with a null
doc_id are scored and held out (the crc32 of an empty text is 0); without training texts N and V
are 0, and the untrained model scores; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernel, wordpieces

FOLDS, FREQUENT = 10, 1 << 20
#: Words whose ids a worker holds, in some 90 MB.
WORDS = 1 << 21
#: Bytes of input a part of the words' hashes; rare words a pack; words a row of merged counts.
PART_BYTES, PACK, CHUNK = 16 << 20, 1 << 19, 1 << 16
#: Windows of a text that share a row; windows of a bucket, about; times that all windows train the attention weights.
SHARE, BUCKET, ROUNDS = 64, 1 << 19, 1
#: Ids of a window, and of its end that are scored; width of the head; groups of classes, and classes a group; classes with one id.
CONTEXT, STRIDE, WIDTH, GROUPS, SINGLE = 32, 24, 16, 32, 960
CLASSES = GROUPS * GROUPS
#: The vocabulary's two special ids; then one for words it drops, and the number of ids.
START, END, STRAY, VOCABULARY = 49406, 49407, 49408, 49409
#: Share of the attention model in a word's probability, and of other spellings in a word's.
MIX, VARIANT = 0.6, 0.01
_PAD = 0xFFFF
_END_HASH = np.uint64(0x1234567890ABCDEF)
_LEAD = CONTEXT - STRIDE


@dataclass
class Attention:
    """Rows by id (query, key, value, self side by side), relative bias, output layers of the group and of the class in each group (the last row is added); by id: class, log10 share within it, log10 chances of going on within a word and of ending it."""

    rows: np.ndarray
    bias: np.ndarray
    group: np.ndarray
    inside: np.ndarray
    classes: np.ndarray
    share: np.ndarray
    on: np.ndarray
    off: np.ndarray

    def copy(self) -> Attention:
        return Attention(self.rows.copy(), self.bias.copy(), self.group.copy(), self.inside.copy(), self.classes, self.share, self.on, self.off)


def initial(counts: np.ndarray, inner: np.ndarray, seed: int = 11) -> Attention:
    """Untrained weights; classes, shares, chances of going on and output bias from the counts by id, and of ids inside words."""
    rng, f = np.random.RandomState(seed), np.float32
    order = np.argsort(-counts, kind="stable")
    on = (inner + 0.1) / (counts + 0.2)
    single, rest = order[:SINGLE], order[SINGLE:]
    mass = np.cumsum(counts[rest] + 0.1)
    classes = np.empty(VOCABULARY, np.int64)
    # ids that words go on after stand together, by frequency
    classes[single[np.argsort(on[single] > 0.5, kind="stable")]] = np.arange(SINGLE)
    classes[rest] = SINGLE + np.minimum((mass / mass[-1] * (CLASSES - SINGLE)).astype(np.int64), CLASSES - SINGLE - 1)
    smooth = counts + 0.1
    held = np.bincount(classes, smooth, CLASSES)
    share = np.log10(smooth / held[classes])
    rows = np.hstack([rng.randn(VOCABULARY, WIDTH) * s for s in (0.3, 0.3, 0.1, 0.1)]).astype(f)
    held = np.log(held.reshape(GROUPS, GROUPS))
    top = np.log(np.exp(held).sum(1))
    group = np.vstack([rng.randn(WIDTH, GROUPS) * 0.3, top[None]]).astype(f)
    inside = np.concatenate([rng.randn(GROUPS, WIDTH, GROUPS) * 0.3, (held - top[:, None])[:, None]], axis=1).astype(f)
    return Attention(rows, (-0.1 * np.arange(CONTEXT)).astype(f), group, inside, classes, share, np.log10(on), np.log10(1 - on))


_LAG = np.arange(CONTEXT)[:, None] - np.arange(CONTEXT)[None, :]
_CAUSAL = _LAG >= 0


def stream(words: kernel.Words, table: wordpieces.WordIds) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, document, word, whether an id is its word's last; by word, its entry) of texts one after another; each begins with START (word -1) and ends with END, and words count on over all texts, the ends included."""
    entry, rows = table.entries(words), words.rows
    row, edge = np.arange(rows), np.arange(len(entry)) + 2 * words.row + 1
    # words with START and END about each text, as words that have one id
    every = np.empty(len(entry) + 2 * rows, np.int64)
    begin = words.first[:-1] + 2 * row
    every[begin], every[words.first[1:] + 2 * row + 1], every[edge] = table.starts, table.ends, entry
    number = np.arange(len(every)) - np.repeat(row + 1, np.diff(words.first) + 2)
    number[begin] = -1
    ids, size = table.ids(every)
    n = np.add.reduceat(size, begin) if rows else size
    last = np.zeros(len(ids), bool)
    last[np.cumsum(size) - 1] = True
    return ids.astype(np.int64), np.repeat(row, n), np.repeat(number, size), last, entry


#: exp2 takes half the time of exp, so logits of classes are made in units of log 2; products of tall matrices are made in blocks of rows.
_TO_2, _TALL = np.float32(1 / np.log(2)), 192


def _tall(x: np.ndarray, w: np.ndarray, out: np.ndarray) -> np.ndarray:
    """x @ w."""
    n = len(x) // _TALL * _TALL
    np.matmul(x[:n].reshape(-1, _TALL, x.shape[1]), w, out=out[:n].reshape(-1, _TALL, w.shape[1]))
    np.matmul(x[n:], w, out=out[n:])
    return out


def _across(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x.T @ y."""
    n = len(x) // _TALL * _TALL
    out = (x[:n].reshape(-1, _TALL, x.shape[1]).transpose(0, 2, 1) @ y[:n].reshape(-1, _TALL, y.shape[1])).sum(axis=0)
    out += x[n:].T @ y[n:]
    return out


def _powers(z: np.ndarray) -> np.ndarray:
    """2 ** z, but for a factor a row where rows need one, in place."""
    if z.max(initial=0) > 115:  # beyond what exp2 holds
        z -= z.max(axis=1, keepdims=True)
    return np.exp2(z, out=z)


def _chosen(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log2 of the softmax of each row of z, in units of log 2, at the given column; z is used up."""
    at = at + z.shape[1] * np.arange(len(z))
    _powers(z)
    return np.log2(z.ravel().take(at) / (z @ np.ones(z.shape[1], np.float32)))


def id_logs(m: Attention, ids: np.ndarray, doc: np.ndarray, batch: int = 192) -> np.ndarray:
    """log10 probability of every id of the stream after those before it in its document (0 for the starts); documents have their own windows."""
    out = np.zeros(len(ids), np.float64)
    if len(ids) < 2:
        return out
    size = np.diff(np.searchsorted(doc, np.arange(doc[-1] + 2))) - 1
    begin = np.cumsum(size + 1) - size - 1
    per = -(-size // STRIDE)
    n, first = int(per.sum()), np.cumsum(per) - per
    # what predicts: all ids but the documents' last; a document's start at the scored part of a window
    goes = np.ones(len(ids), bool)
    goes[begin + size] = False
    then = np.ones(len(ids), bool)
    then[begin] = False
    at = np.arange(len(ids) - len(size))
    at += np.repeat(first * STRIDE - np.cumsum(size) + size, size)
    nxt = ids[then]
    x, target = np.full(_LEAD + n * STRIDE, START), np.zeros(n * STRIDE, np.int64)
    x[at + _LEAD], target[at] = ids[goes], m.classes[nxt]
    lead = np.zeros(n, bool)
    lead[first[size > 0]] = True  # what stands before these windows is no context
    logs = np.empty(n * STRIDE, np.float32)
    place = np.where(_CAUSAL, m.bias[np.abs(_LAG)], np.float32(-1e4))[_LEAD:]
    ones, h_all = np.ones(CONTEXT, np.float32), np.ones((batch * STRIDE, WIDTH + 1), np.float32)
    z_all = np.empty((batch * STRIDE, GROUPS), np.float32)
    group, inside = m.group * _TO_2, m.inside * _TO_2
    for b in range(0, n, batch):
        k = min(batch, n - b)
        t = m.rows.take(x[b * STRIDE : (b + k) * STRIDE + _LEAD], axis=0)
        view = np.lib.stride_tricks.as_strided(t, (k, CONTEXT, 4 * WIDTH), (t.strides[0] * STRIDE, *t.strides))
        a = view[:, _LEAD:, :WIDTH] @ view[:, :, WIDTH : 2 * WIDTH].transpose(0, 2, 1)
        a += place
        a[lead[b : b + k], :, :_LEAD] = -1e4
        if a.max() > 60:
            np.minimum(a, 60, out=a)
        np.exp(a, out=a)
        h = h_all[: k * STRIDE]
        g = a @ view[:, :, 2 * WIDTH : 3 * WIDTH]
        g *= (np.float32(1) / (a.reshape(-1, CONTEXT) @ ones)).reshape(k, STRIDE, 1)
        g += view[:, _LEAD:, 3 * WIDTH :]
        g = g.reshape(-1, WIDTH)
        np.maximum(g, np.float32(0.1) * g, out=h[:, :WIDTH])
        want = target[b * STRIDE : (b + k) * STRIDE]
        own = want // GROUPS
        z = z_all[: len(h)]
        logs[b * STRIDE : (b + k) * STRIDE] = _chosen(_tall(h, group, z), own)
        order = np.argsort(own.astype(np.uint8), kind="stable")
        edge = np.searchsorted(own[order], np.arange(GROUPS + 1))
        h = h.take(order, axis=0)
        for c in range(GROUPS):
            np.matmul(h[edge[c] : edge[c + 1]], inside[c], out=z[edge[c] : edge[c + 1]])
        logs[b * STRIDE + order] += _chosen(z, (want - GROUPS * own)[order])
    out[then] = logs[at] * np.log10(2) + m.share[nxt]
    return out


def training_rows(ids: np.ndarray, doc: np.ndarray, share: int = SHARE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, numbers of windows, ids) of rows that hold all windows of CONTEXT ids and the one after, up to `share` neighbouring ones a row; each lies in one document, padded beyond it."""
    n = np.bincount(doc)
    begin = np.cumsum(n) - n
    per = -(-(n - 1) // STRIDE)
    rows = -(-per // share)
    of = np.repeat(np.arange(len(n)), rows)
    first = share * (np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows))
    windows = np.minimum(share, per[of] - first)
    size = _LEAD + STRIDE * windows + 1
    edge = np.cumsum(size) - size
    within = np.arange(int(size.sum())) - np.repeat(edge, size)
    at = np.repeat(STRIDE * first - _LEAD, size) + within  # in the document
    inside = (at >= 0) & (at < np.repeat(n[of], size))
    at += np.repeat(begin[of], size)
    flat = np.where(inside, ids[np.clip(at, 0, len(ids) - 1)], _PAD).astype(np.uint16)
    h = kernel.mix((within.astype(np.uint64) << np.uint64(16)) | flat)
    return kernel.mix(np.add.reduceat(h, edge)), windows, flat


def all_windows(rows: list[bytes]) -> np.ndarray:
    """All windows, CONTEXT + 1 ids each, of such rows' ids."""
    flat = np.frombuffer(b"".join(rows), np.uint16)
    size = np.array([len(x) // 2 for x in rows])
    per = (size - _LEAD - 1) // STRIDE
    start = np.repeat(np.cumsum(size) - size, per) + STRIDE * (np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per))
    return np.lib.stride_tricks.sliding_window_view(flat, CONTEXT + 1)[start]


def _slope(z: np.ndarray, at: np.ndarray, each: np.float32) -> np.ndarray:
    """Gradient, by the logits, of the mean negative log-softmax at the given columns of logits in units of log 2; z is used up."""
    _powers(z)
    z *= (each / (z @ np.ones(z.shape[1], np.float32)))[:, None]
    z.ravel()[at + z.shape[1] * np.arange(len(z))] -= each
    return z


def fit(m: Attention, rows: np.ndarray, epochs: int = 1, batch: int = 128, rate: float = 0.02, seed: int = 11) -> Attention:
    """Train m in place by Adam on windows of CONTEXT + 1 ids (_PAD where there is none)."""
    rng, f = np.random.RandomState(seed), np.float32
    weights = (m.rows, m.bias, m.group, m.inside)
    first, second, step = [np.zeros_like(t) for t in weights], [np.zeros_like(t) for t in weights], 0
    w, lag = WIDTH, np.abs(_LAG[_LEAD:])
    ahead = np.where(_CAUSAL[_LEAD:], f(0), f(-1e4))
    ones = np.ones(CONTEXT, f)
    # what every step writes anew; gradients of query and self are 0 where nothing is predicted, flat and turned end with 1
    z, d_inside, more = np.empty((2 * batch * STRIDE, GROUPS), f), np.empty_like(m.inside), np.empty((2 * batch * STRIDE, w), f)
    inside = np.empty_like(m.inside)
    by_class = [(inside[c], d_inside[c], m.inside[c, :w].T) for c in range(GROUPS)]  # m.inside is trained in place
    d_rows, dh_all = [np.zeros((2 * batch, CONTEXT, w), f) for _ in range(4)], np.empty((2 * batch * STRIDE, w + 1), f)
    flat_all, turned_all = np.ones((2 * batch * STRIDE, w + 1), f), np.ones((2 * batch, 2 * w + 1, CONTEXT), f)
    for epoch in range(epochs):
        for chosen in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            x = rows.take(chosen, axis=0)
            n, there = len(x), x != _PAD
            x[~there] = START
            t = m.rows.take(x[:, :-1], axis=0)
            q, k, v, own = t[:, _LEAD:, :w], t[:, :, w : 2 * w], t[:, :, 2 * w : 3 * w], t[:, _LEAD:, 3 * w :]
            turned = turned_all[:n]
            turned[:, : 2 * w] = t[:, :, w : 3 * w].transpose(0, 2, 1)  # products with turned views take longer
            a = q @ turned[:, :w]
            a += m.bias[lag] + ahead
            short = np.flatnonzero(~there[:, :-1].all(axis=1))
            if len(short):
                a[short] += (there[short, None, :-1] - f(1)) * f(1e4)
            if a.max() > 60:
                np.minimum(a, 60, out=a)
            np.exp(a, out=a)  # exp2 is slow where it gives 0
            a *= (f(1) / np.maximum(a.reshape(-1, CONTEXT) @ ones, f(1e-30))).reshape(n, STRIDE, 1)
            mean = a @ v
            h = mean + own
            flat = flat_all[: n * STRIDE]
            np.maximum(h, f(0.1) * h, out=flat.reshape(n, STRIDE, w + 1)[:, :, :w])
            want = m.classes[x[:, _LEAD + 1 :].ravel()]
            of = want // GROUPS
            group = of.astype(np.uint8)
            group[~(there[:, _LEAD + 1 :] & there[:, _LEAD:-1]).ravel()] = GROUPS
            order = np.argsort(group, kind="stable")
            edge = np.searchsorted(group[order], np.arange(GROUPS + 1))
            order, rest = order[: edge[-1]], order[edge[-1] :]
            flat_o, of, each = flat.take(order, axis=0), of[order], f(1 / max(1, len(order)))
            within = want[order] - GROUPS * of
            g = _slope(_tall(flat_o, m.group * _TO_2, z[: len(flat_o)]), of, each)
            d_group, back = _across(flat_o, g), _tall(g, m.group[:w].T, np.empty((len(g), w), f))
            np.multiply(m.inside, _TO_2, out=inside)
            parts = [(by_class[c], flat_o[i:j], z[i:j], more[i:j]) for c, (i, j) in enumerate(zip(edge.tolist(), edge[1:].tolist(), strict=False)) if i < j]
            for (layer, _, _), x_c, z_c, _ in parts:
                np.matmul(x_c, layer, out=z_c)
            _slope(z[: len(flat_o)], within, each)
            if len(parts) < GROUPS:
                d_inside[:] = 0
            for (_, d_layer, turned_layer), x_c, z_c, more_c in parts:
                np.matmul(x_c.T, z_c, out=d_layer)
                np.matmul(z_c, turned_layer, out=more_c)
            back += more[: len(back)]
            both = dh_all[: n * STRIDE]
            both[order, :w], both[rest] = back, 0
            both = both.reshape(n, STRIDE, w + 1)
            np.copysign(f(0.45), h, out=h)
            h += f(0.55)  # 1, or 0.1 below 0
            h *= both[:, :, :w]
            both[:, :, :w], dh = h, h
            mean *= dh
            np.negative((mean.reshape(-1, w) @ ones[:w]).reshape(n, STRIDE), out=both[:, :, w])
            da = both @ turned[:, w:]  # less the mean of each row
            da *= a
            d = [x[:n] for x in d_rows]
            np.matmul(da, k, out=d[0][:, _LEAD:])
            np.matmul(da.transpose(0, 2, 1), q, out=d[1])
            np.matmul(a.transpose(0, 2, 1), dh, out=d[2])
            d[3][:, _LEAD:] = dh
            d_bias = np.bincount(lag.ravel(), da.sum(0).ravel(), CONTEXT).astype(f)
            seen = x[:, :-1].ravel()
            order = np.argsort(seen, kind="stable")
            seen = seen[order]
            at = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
            summed = np.empty((len(at), 4 * w), f)
            for part, own in enumerate(d):
                summed[:, part * w : (part + 1) * w] = np.add.reduceat(own.reshape(-1, w).take(order, axis=0).view(np.complex64), at).view(f)  # two columns at a time
            grads = [(seen[at].astype(np.int64), summed), (slice(None), d_bias), (slice(None), d_group), (slice(None), d_inside)]
            step += 1
            scale = rate * min(1.0, step / 10) * (1 - 0.9 * epoch / epochs)
            # first and second hold the usual moments over 0.1 and 0.01
            r = (0.01 / (1 - 0.99**step)) ** 0.5
            by, least = f(0.1 * scale / (1 - 0.9**step) / r), f(1e-7 / r)
            for tab, p, s, (i, grad) in zip(weights, first, second, grads, strict=True):
                some = isinstance(i, np.ndarray)
                move, square = (p.take(i, axis=0), s.take(i, axis=0)) if some else (p, s)
                move *= f(0.9)
                move += grad
                grad *= grad
                square *= f(0.99)
                square += grad
                if some:
                    p[i], s[i] = move, square
                np.sqrt(square, out=grad)
                grad += least
                np.divide(move, grad, out=grad)
                grad *= by
                if some:
                    tab[i] = np.subtract(tab.take(i, axis=0), grad, out=grad)
                else:
                    tab -= grad
    return m


_ROW = 4 * WIDTH
_SIZES = (CONTEXT, (WIDTH + 1) * GROUPS, (WIDTH + 1) * CLASSES)
_OTHERS = -(-sum(_SIZES) // _ROW)


def packed(m: Attention) -> np.ndarray:
    """All weights as rows: one an id, and _OTHERS more."""
    others = np.zeros(_OTHERS * _ROW, np.float32)
    flat = np.concatenate([m.bias, m.group.ravel(), m.inside.ravel()])
    others[: len(flat)] = flat
    return np.concatenate([m.rows, others.reshape(_OTHERS, _ROW)])


def unpacked(rows: np.ndarray, like: Attention) -> Attention:
    """The model of such rows, with what like has from counts."""
    rows = rows.astype(np.float32)
    others = rows[VOCABULARY:].ravel()
    at = np.cumsum([0, *_SIZES])
    bias, group, inside = (others[i:j].copy() for i, j in zip(at, at[1:], strict=False))
    return Attention(rows[:VOCABULARY].copy(), bias, group.reshape(-1, GROUPS), inside.reshape(GROUPS, -1, GROUPS), like.classes, like.share, like.on, like.off)


def _fresh(hashes: list[int], seen: set[int]) -> list[int]:
    """Places of hashes that are not in seen, to which they go; it starts anew when it is large."""
    new = []
    for i, h in enumerate(hashes):
        if h not in seen:
            seen.add(h)
            new.append(i)
    if len(seen) > 1 << 18:
        seen.clear()
    return new


def once(rows: DataFrame) -> DataFrame:
    """rows (h, ids), each h once a task, for rows that gather did not mark."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            yield batch.take(pa.array(_fresh(batch.column(0).to_pylist(), seen), pa.int64()))

    return rows.mapInArrow(body, "h long, ids binary")


def trained_round(start: Attention, rows: DataFrame, buckets: int, rate: float) -> Attention:
    """start, trained on by the windows of rows (h, ids), each h once: each bucket on its own, then averaged."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(start)
    names = [f"w{k}" for k in range(_ROW)]

    def body(table: pa.Table) -> pa.Table:
        _, one = np.unique(table["h"].to_numpy(), return_index=True)
        windows = all_windows(table["ids"].take(pa.array(one)).to_pylist())
        own = fit(shared.value.copy(), windows, rate=rate)
        n = np.bincount(windows[:, :-1].ravel(), minlength=_PAD + 1)[:VOCABULARY]
        seen = np.flatnonzero(n)
        seen, n = np.concatenate([seen, np.arange(VOCABULARY, VOCABULARY + _OTHERS)]).astype(np.int32), np.concatenate([n[seen], np.full(_OTHERS, len(windows))])
        values = packed(own)[seen] * n[:, None].astype(np.float32)
        return pa.table([pa.array(seen), pa.array(n.astype(np.float64)), *[pa.array(x) for x in np.ascontiguousarray(values.T)]], ["id", "n", *names])

    fitted = rows.withColumn("bucket", F.pmod("h", F.lit(buckets))).groupBy("bucket").applyInArrow(body, ", ".join(["id int", "n double", *[f"{x} float" for x in names]]))
    summed = common.save(fitted.groupBy("id").agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in names]), "weights")
    found = summed.toPandas()  # at most one row an id
    common.drop(summed, shared)
    rows = packed(start)
    if len(found):
        rows[found["id"].to_numpy()] = found[names].to_numpy() / found["n"].to_numpy()[:, None]
    return unpacked(rows, start)


def part_count(docs: DataFrame, size: int = PART_BYTES) -> int:
    """Parts of the words' hashes for docs (text), by the bytes that the plan expects, or those counted where it knows none."""
    known = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known >= 1 << 50:
        known = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, min(-(-known // size), 1 << 15))


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Parts in the order of the hashes."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16)


def _blobs(columns: list[np.ndarray], edge: np.ndarray) -> list[bytes]:
    """For each range between edges, its values of every column, one column after another."""
    return [b"".join(x[a:b].tobytes() for x in columns) for a, b in zip(edge.tolist(), edge[1:].tolist(), strict=False)]


def _counted(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of blobs of both."""
    both = [np.frombuffer(x, np.uint64) for x in blobs]
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *[x[: len(x) // 2] for x in both]]), np.concatenate([empty, *[x[len(x) // 2 :] for x in both]]).view(np.int64)


def _summed(word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash once, in order, with the sum of its counts."""
    if not len(word):
        return word, n
    order = np.argsort(word)
    word, n = word[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return word[at], np.add.reduceat(n, at)


def gather(texts: DataFrame, path: str, share: int = SHARE, parts: int = 1) -> DataFrame:
    """From one pass over texts (text): kind 0 part of the words' 64-bit hashes (the end's among them), number of them, hashes and counts, 1 subword id, count and count inside words, 2 hash, number of windows and ids of a row of training windows, and 1 as the second count where this task had them before."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = ends = 0
        table = wordpieces.shared(path, STRAY, START, WORDS)
        per_id, inner, seen = np.zeros(VOCABULARY, np.int64), np.zeros(VOCABULARY, np.int64), set()

        def rows(kind: int, word: np.ndarray, c: np.ndarray, c2: np.ndarray, ids: np.ndarray | None = None) -> pa.RecordBatch:
            n = len(word)
            longs = [pa.array(x.astype(np.int64)) for x in (c, c2)]
            if ids is None:
                blobs = pa.nulls(n, pa.binary())
            else:
                edge = np.concatenate([[0], np.cumsum(2 * (_LEAD + STRIDE * c + 1))])
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(edge), pa.py_buffer(ids)]).cast(pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), pa.array(word.view(np.int64)), *longs, blobs], ["kind", "word", "c", "c2", "ids"])

        def merge() -> None:
            held[:] = [_summed(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))]

        def counted(word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            edge = np.searchsorted(part_of(word, parts), np.arange(parts + 1))
            some = np.flatnonzero(np.diff(edge))
            blobs = _blobs([word, n], edge)
            size = np.diff(edge)[some]
            longs = [some, size, size]
            return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(some), np.int8)), *[pa.array(x.astype(np.int64)) for x in longs], pa.array([blobs[k] for k in some.tolist()], pa.binary())], ["kind", "word", "c", "c2", "ids"])

        for batch in batches:
            data, offsets = kernel.utf8(batch.column(0))
            ends += batch.num_rows
            for a, b in kernel.blocks(offsets):
                words = kernel.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
                h, n = np.unique(words.hashes(), return_counts=True)
                if len(h):
                    held.append((h, n))
                    size += len(h)
                ids, doc, _, last, _ = stream(words, table)
                per_id += np.bincount(ids, minlength=VOCABULARY)
                inner += np.bincount(ids[~last], minlength=VOCABULARY)
                own, windows, flat = training_rows(ids, doc, share)
                yield rows(2, own, windows, np.isin(np.arange(len(own)), _fresh(own.tolist(), seen), invert=True), flat)
                if size > 1 << 20:
                    merge()
                    size = len(held[0][0])
                    if size > 1 << 19:
                        yield counted(*held[0])
                        held.clear()
                        size = 0
        if ends:
            held.append((np.array([_END_HASH]), np.array([ends])))
            merge()
            yield counted(*held[0])
            per_id[START] = 0
            there = np.flatnonzero(per_id)
            yield rows(1, there, per_id[there], inner[there])

    return texts.select("text").mapInArrow(body, "kind byte, word long, c long, c2 long, ids binary")


@dataclass
class Learned:
    """counts (part, n, total, blob of hashes and counts) of all training words, number of parts, N, V and the attention model."""

    counts: DataFrame
    parts: int
    total: int
    distinct: int
    model: Attention

    @property
    def floor(self) -> float:
        return float(np.log10(self.total + 0.1 * (self.distinct + 1)))


def merged(rows: DataFrame) -> DataFrame:
    """(part, n, total, counts) of rows (part, ids): each hash of a part once, up to CHUNK a row."""

    def body(table: pa.Table) -> pa.Table:
        word, n = _summed(*_counted(table["ids"].to_pylist()))
        edge = np.append(np.arange(0, len(word), CHUNK), len(word))
        return pa.table([pa.array([table["part"][0].as_py()] * (len(edge) - 1), pa.int64()), pa.array(np.diff(edge)), pa.array(np.add.reduceat(n, edge[:-1])), pa.array(_blobs([word, n], edge), pa.binary())], ["part", "n", "total", "counts"])

    return rows.groupBy("part").applyInArrow(body, "part long, n long, total long, counts binary")


def often(learned: Learned, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the words that make up more than 1 / frequent of all, of which there are at most `frequent`."""
    total = learned.total

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = _counted(batch.column(0).to_pylist())
            keep = n > total // frequent  # n and total are whole
            yield pa.RecordBatch.from_arrays([pa.array(word[keep].view(np.int64)), pa.array(n[keep])], ["word", "c"])

    known = learned.counts.select("counts").mapInArrow(body, "word long, c long").toPandas()
    return known["word"].to_numpy(np.int64).view(np.uint64), known["c"].to_numpy(np.int64)


def learn(training: DataFrame, path: str, share: int = SHARE, bucket: int = BUCKET, rounds: int = ROUNDS) -> Learned:
    """What all rows of training (text) give."""
    parts = part_count(training)
    raw = common.save(gather(training.select(F.coalesce("text", F.lit("")).alias("text")), path, share, parts), "gathered", "snappy")
    counts = common.save(merged(raw.where("kind = 0").select(F.col("word").alias("part"), "ids")), "counts")
    found = raw.where("kind = 1").groupBy("word").agg(F.sum("c").alias("c"), F.sum("c2").alias("c2")).toPandas()  # at most one row an id
    n = raw.where("kind = 2").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    windows = raw.where("kind = 2 AND c2 = 0").select(F.col("word").alias("h"), "ids")  # so that no bucket is sent all copies of a text
    total, distinct = counts.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ids = found["word"].to_numpy(np.int64)
    m = initial(*[np.bincount(ids, found[c].to_numpy(np.float64), VOCABULARY) for c in ("c", "c2")])
    for k in range(rounds if n else 0):
        m = trained_round(m, windows, max(1, -(-n // bucket)), 0.02 / (k + 1))
    common.drop(raw)
    return Learned(counts, parts, total, distinct, m)


def _mixed(base: np.ndarray, model: np.ndarray) -> np.ndarray:
    """log10 of the mixture, from log10s; that of base is never so low that a float does not hold it."""
    x, y = base + np.log10(1 - MIX), model + np.log10(MIX)
    return np.log10(np.exp(x * np.log(10)) + np.exp(y * np.log(10)))


def word_logs(m: Attention, words: kernel.Words, table: wordpieces.WordIds) -> np.ndarray:
    """log10 probability under attention of every word of these texts, their ends included."""
    return _word_logs(m, words, table)[0]


def _word_logs(m: Attention, words: kernel.Words, table: wordpieces.WordIds) -> tuple[np.ndarray, np.ndarray]:
    """The same, and the entries of the words, without the ends."""
    ids, doc, number, last, entry = stream(words, table)
    same = table.same[entry]
    logs = id_logs(m, ids, doc)
    chance = np.stack([m.on, m.off])
    chance[:, [START, END]] = 0
    logs += chance.ravel().take(ids + VOCABULARY * last)
    number += 1
    per = np.bincount(number, logs, len(words.start) + words.rows + 1)[1:]  # all but the starts
    per[np.arange(len(words.start)) + words.row] += np.where(same, np.log10(1 - VARIANT), np.log10(VARIANT) - words.length * np.log10(4))
    return per, entry


_SCORED = "pack long, part int, blob binary, place int, doc_id long, n_tokens long, n_known long, base double, score double"
_COLUMNS = [x.split()[0] for x in _SCORED.split(", ")]
#: Parts of rows that are none of the questions: a document, and the places and log10s under attention of a pack's rare words.
_DOCUMENT, _OWN = -2, -1


def _answers(table: pa.Table) -> pa.Table:
    """To every question (pack, part, hashes) the counts of its words, by the part's merged counts (no pack)."""
    word, n = _counted(table.filter(table["pack"].is_null())["blob"].to_pylist())
    asked = table.filter(table["pack"].is_valid())
    order = np.argsort(word)
    word, n = np.append(word[order], ~np.uint64(0)), np.append(n[order], 0)  # the last one is no word's, or has its own before it
    out = []
    for x in asked["blob"].to_pylist():
        h = np.frombuffer(x, np.uint64)
        at = np.searchsorted(word, h)
        out.append(np.where(word[at] == h, n[at], 0).tobytes())
    return pa.table([asked["pack"], asked["part"].cast(pa.int32()), pa.array(out, pa.binary())], ["pack", "part", "blob"])


def _totals(floor: float):
    def body(table: pa.Table) -> pa.Table:
        """The documents of a pack, with what its rare words add."""
        part = table["part"].to_numpy()
        blob = table["blob"]
        docs = table.filter(pa.array(part == _DOCUMENT))
        place, columns = docs["place"].to_numpy(), [docs[c].to_numpy() for c in ("n_known", "base", "score")]
        of = np.zeros(int(place.max(initial=-1)) + 1, np.int64)
        of[place] = np.arange(len(place))
        answers = np.flatnonzero(part >= 0)
        c = np.frombuffer(b"".join(blob[k].as_py() for k in answers[np.argsort(part[answers])].tolist()), np.int64)
        own = blob.filter(pa.array(part == _OWN)).to_pylist()
        if len(c):
            row = of[np.frombuffer(own[0][: 4 * len(c)], np.uint32)]
            per = np.frombuffer(own[0][4 * len(c) :], np.float64)
            base = np.log10(c + 0.1) - floor
            columns = [x + np.bincount(row, y, len(place)).astype(x.dtype) for x, y in zip(columns, (c > 0, base, _mixed(base, per)), strict=True)]
        return pa.table([docs["doc_id"], docs["n_tokens"], *[pa.array(x) for x in columns]], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return body


def score(docs: DataFrame, learned: Learned, path: str, frequent: int = FREQUENT, pack: int = PACK) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of docs (doc_id, text)."""
    spark, total, parts, floor = docs.sparkSession, learned.total, learned.parts, learned.floor
    word, c = often(learned, frequent)
    table: Broadcast = spark.sparkContext.broadcast((learned.model, wordpieces.Slots(word), np.append(np.log10(c + 0.1) - floor, 0.0)))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known, log_c = table.value
        ids_of, end_at = wordpieces.shared(path, STRAY, START, WORDS), known.find(np.array([_END_HASH]))[0]
        number = TaskContext.get().partitionId() << 32  # rows are saved with these numbers before anything is sent to a pack
        rows: list[pa.RecordBatch] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = place = 0

        def done() -> Iterator[pa.RecordBatch]:
            """The rows of a pack: its documents, questions and the rest of its rare words, in the order of the questions."""
            yield from rows
            h, at, per = (np.concatenate(x) for x in zip(*held, strict=True))
            part = part_of(h, parts)
            order = np.argsort(part, kind="stable")
            edge = np.searchsorted(part[order], np.arange(parts + 1))
            some = np.flatnonzero(np.diff(edge))
            asked = _blobs([h[order]], edge)
            if len(h):
                kinds = np.append(some, _OWN).astype(np.int32)
                blobs = pa.array([*[asked[k] for k in some.tolist()], b"".join((at[order].tobytes(), per[order].tobytes()))], pa.binary())
                n = len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), pa.array(kinds), blobs, pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.int64())] * 3, *[pa.nulls(n, pa.float64())] * 2], _COLUMNS)
            rows.clear()
            held.clear()

        for batch in batches:
            data, offsets = kernel.utf8(batch.column(1))
            for a, b in kernel.blocks(offsets):
                words = kernel.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
                per, entry = _word_logs(m, words, ids_of)
                n = np.diff(words.first)
                row = np.repeat(np.arange(b - a), n + 1)
                # words with their text's end after them
                h, at = np.full(len(row), _END_HASH, np.uint64), np.full(len(row), end_at)
                own = np.arange(len(words.start)) + words.row
                h[own], at[own] = words.hashes(), ids_of.found(known, entry)
                rare = at < 0
                base = log_c[at]
                mixed = _mixed(base, per)
                base[rare] = mixed[rare] = 0
                some = [np.bincount(row, x, b - a) for x in (base, mixed)]
                sizes = [pa.array(n + 1, pa.int64()), pa.array(n + 1 - np.bincount(row[rare], minlength=b - a), pa.int64())]
                here = place + np.arange(b - a)
                rows.append(pa.RecordBatch.from_arrays([pa.array(np.full(b - a, number)), pa.array(np.full(b - a, _DOCUMENT, np.int32)), pa.nulls(b - a, pa.binary()), pa.array(here.astype(np.int32)), batch.column(0).slice(a, b - a), *sizes, *[pa.array(x) for x in some]], _COLUMNS))
                rare = np.flatnonzero(rare)
                held.append((h[rare], here[row[rare]].astype(np.uint32), per[rare]))
                size, place = size + len(rare), place + b - a
                if size >= pack:
                    yield from done()
                    size, place, number = 0, 0, number + 1
        if rows:
            yield from done()

    rows = common.save(docs.select("doc_id", "text").mapInArrow(body, _SCORED), "scored")
    common.drop(table)
    known = learned.counts.select("part", F.lit(None).cast("long").alias("pack"), F.col("counts").alias("blob"))
    asked = rows.where("part >= 0").select(F.col("part").cast("long").alias("part"), "pack", "blob")
    answers = asked.unionByName(known).groupBy("part").applyInArrow(_answers, "pack long, part int, blob binary")
    every = rows.where("part < 0").unionByName(answers, allowMissingColumns=True)
    summed = every.groupBy("pack").applyInArrow(_totals(floor), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return summed.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def held_out(column: str = "doc_id"):
    return F.pmod(common.crc_of_id(column), F.lit(FOLDS)) == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p

    docs, path = common.table(spark, sf_dir, "documents"), p.path("word_bpe_49k.json")
    out = score(docs, learn(docs.where(~held_out()), path), path)
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
