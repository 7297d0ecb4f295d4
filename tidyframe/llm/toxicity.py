"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input is its hashed word embedding beside the mean of its hashed
character n-gram embeddings.  A window of ``WINDOW`` words runs through a GRU in
both directions; attention pools the states into one logit.  All windows of a
text, each overlapping the next by half, are scored and the highest counts, so a
short insult in a long text is not averaged away.

Training (numpy, on the driver) uses a bounded sample of labelled documents:
the ``max_docs`` per class with the least hash of their id, at most
``max_windows`` windows of each, evenly spread.  A document's label is learnt
through noisy-or over its windows.  Scoring runs in the tasks, on whole texts.

Defined results: a null or empty text scores 0; without labels of both classes
every score is 0; a document labelled twice counts as toxic if one label says so;
repeated rows score alike; an empty table gives no rows; null ids are scored and
never learnt from; extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyframe.llm.common import slices

WINDOW, STEP = 48, 24
HIDDEN, DIM, SLOTS = 8, 8, 1 << 16
NGRAMS = (3, 4, 5)
BATCH = 2048         # windows run together
MAX_DOCS = 1000      # sampled documents per class
MAX_WINDOWS = 100    # windows of a sampled document
MIN_DOCS = 4         # inputs of fewer sampled documents stay at zero: they only memorise
STEPS, RATE, DOCS_A_STEP = 120, 0.02, 48   # half of a step's documents from each class
INPUT_WORDS = 1 << 13  # distinct words whose inputs are made at a time
GROUP = 768          # windows whose states a training step holds at a time, or one document's
SCORE = "__score"
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def is_held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _words(text) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(None, _PUNCTUATION).split()


def _inputs(words: list[bytes]):
    """Hashed inputs of distinct words: word slots, then character n-gram slots as
    one array with each word's start.  Words go in blocks: the arrays on the way take many
    times a word's bytes."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    slots = np.fromiter((digest(w) % SLOTS for w in words), dtype=np.int32, count=len(words))
    if not words:
        return slots, slots, slots.astype(np.int64)
    blocks = [_grams(words[k:k + INPUT_WORDS]) for k in range(0, len(words), INPUT_WORDS)]
    before = np.cumsum([0, *(len(g) for g, _ in blocks)])
    return (slots, np.concatenate([g for g, _ in blocks]),
            np.concatenate([s + n for (_, s), n in zip(blocks, before[:-1], strict=True)]))


def _grams(words: list[bytes]):
    """Character n-gram slots of some words, and each word's start."""
    marked = [b"^" + w + b"$$$" for w in words]  # three ends: every word has each n-gram length
    raw = np.frombuffer(b"".join(marked) + b"\0" * max(NGRAMS), dtype=np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(words))
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(ends))
    grams, owners = [], []
    owner = np.repeat(np.arange(len(words)), sizes)
    for n in NGRAMS:
        code = np.zeros(len(ends), dtype=np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + raw[k:k + len(ends)]
        code = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        inside = at + n <= ends
        grams.append(((code[inside] >> np.uint64(40)) % np.uint64(SLOTS)).astype(np.int32))
        owners.append(owner[inside])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return grams[order], np.searchsorted(owners[order], np.arange(len(words)))


def _mean_rows(table, grams, starts):
    sums = np.add.reduceat(table[grams], starts, axis=0)
    return sums / np.diff(np.append(starts, len(grams)))[:, None].astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def new_model(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    model = {"word": 0.1 * rng.standard_normal((SLOTS, DIM)).astype(np.float32),
             "char": 0.1 * rng.standard_normal((SLOTS, DIM)).astype(np.float32)}
    for d in "fb":
        model |= {f"W{d}": normal(2 * DIM, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32),
                  f"U{d}": normal(HIDDEN, 3 * HIDDEN)}
    return model | {"A": normal(2 * HIDDEN, HIDDEN), "v": normal(HIDDEN, 1)[:, 0],
                    "o": normal(2 * HIDDEN, 1)[:, 0], "bias": np.full(1, -3, np.float32)}


def _run_gru(gates, mask, U, keep=None):
    """States (time, batch, HIDDEN) of one direction; ``gates``: input parts of the
    reset, update and new gates; masked steps leave the state as it is."""
    steps, batch, _ = gates.shape
    h = np.zeros((batch, HIDDEN), np.float32)
    out = np.empty((steps, batch, HIDDEN), np.float32)
    for t in range(steps):
        own = h @ U
        rz = _sigmoid(gates[t, :, :2 * HIDDEN] + own[:, :2 * HIDDEN])
        r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
        new = np.tanh(gates[t, :, 2 * HIDDEN:] + r * own[:, 2 * HIDDEN:])
        if keep is not None:
            keep.append((h, r, z, new, own[:, 2 * HIDDEN:]))
        h = h + mask[t] * (1 - z) * (new - h)
        out[t] = h
    return out


def _attend(model, states, mask):
    hidden = np.tanh(states @ model["A"])
    e = hidden @ model["v"] + np.where(mask[..., 0] > 0, 0, -1e9).astype(np.float32)
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    pooled = (a[..., None] * states).sum(0)
    return hidden, a, pooled, pooled @ model["o"] + model["bias"][0]


def _forward(model, gates, index, keep=None):
    """Logits of the windows in the columns of ``index`` (time, batch); -1 pads."""
    mask = (index >= 0)[..., None].astype(np.float32)
    kept = ([], []) if keep is not None else (None, None)
    f = _run_gru(gates["f"][index], mask, model["Uf"], kept[0])
    b = _run_gru(gates["b"][index[::-1]], mask[::-1], model["Ub"], kept[1])[::-1]
    states = np.concatenate([f, b], axis=2)
    hidden, a, pooled, logit = _attend(model, states, mask)
    if keep is not None:
        keep.update(mask=mask, kept=kept, states=states, hidden=hidden, a=a, pooled=pooled)
    return logit


def _gates(model, x):
    return {d: x @ model[f"W{d}"] + model[f"c{d}"] for d in "fb"}


def _embed(model, inputs):
    slots, grams, starts = inputs
    return np.concatenate([model["word"][slots], _mean_rows(model["char"], grams, starts)], axis=1)


def _windows(n: int) -> np.ndarray:
    """Starts of the windows over a text of ``n`` words."""
    return np.arange(max(1, -(-(n - (WINDOW - STEP)) // STEP))) * STEP if n else np.empty(0, int)


# -------------------------------------------------------------------- training


def _gru_back(d_out, mask, U, kept):
    """Gradients of the input gates and of U, last step first."""
    steps, batch, _ = d_out.shape
    d_gates = np.empty((steps, batch, 3 * HIDDEN), np.float32)
    d_u, dh = np.zeros_like(U), np.zeros((batch, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, r, z, new, own = kept[t]
        dh = dh + d_out[t]
        m = mask[t]
        d_new = dh * m * (1 - z) * (1 - new * new)
        d_z = dh * m * (h - new) * z * (1 - z)
        d_r = d_new * own * r * (1 - r)
        d_gates[t] = np.concatenate([d_r, d_z, d_new], axis=1)
        d_own = np.concatenate([d_r, d_z, d_new * r], axis=1)
        d_u += h.T @ d_own
        dh = dh * (1 - m * (1 - z)) + d_own @ U.T
    return d_gates, d_u


def _gradients(model, x, index, doc_of, labels, docs: int | None = None):
    """Gradients of the mean document loss; rows of ``x`` are the distinct words.  For
    some of a step's documents, ``docs`` is their number in the whole step."""
    keep: dict = {}
    gates = _gates(model, x)
    logit = _forward(model, gates, index, keep)
    p = _sigmoid(logit)
    none = np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-6)), len(labels))  # log P(no window)
    clean = np.minimum(np.exp(none), 1 - 1e-6)
    factor = np.where(labels == 1, -clean / (1 - clean), 1.0)
    d_logit = (p * factor[doc_of] / (docs or len(labels))).astype(np.float32)
    loss = -np.where(labels == 1, np.log(1 - clean), none).mean()

    g = {"bias": d_logit.sum(keepdims=True), "o": keep["pooled"].T @ d_logit}
    d_pooled = d_logit[:, None] * model["o"]
    d_a = (keep["states"] * d_pooled).sum(2)
    d_e = keep["a"] * (d_a - (keep["a"] * d_a).sum(0))
    g["v"] = np.einsum("tbh,tb->h", keep["hidden"], d_e)
    d_hidden = d_e[..., None] * model["v"] * (1 - keep["hidden"] ** 2)
    g["A"] = np.einsum("tbs,tbh->sh", keep["states"], d_hidden)
    d_states = keep["a"][..., None] * d_pooled + d_hidden @ model["A"].T
    mask, d_x = keep["mask"], np.zeros_like(x)
    for d, part, k, turn in (("f", d_states[..., :HIDDEN], keep["kept"][0], 1),
                             ("b", d_states[..., HIDDEN:], keep["kept"][1], -1)):
        d_gates, g[f"U{d}"] = _gru_back(part[::turn], mask[::turn], model[f"U{d}"], k)
        real = index[::turn] >= 0
        per_word = np.zeros((len(x), 3 * HIDDEN), np.float32)
        np.add.at(per_word, index[::turn][real], d_gates[real])
        g[f"W{d}"], g[f"c{d}"] = x.T @ per_word, per_word.sum(0)
        d_x += per_word @ model[f"W{d}"].T
    return loss, g, d_x


def _frequent(docs, slots, starts) -> np.ndarray:
    """1 for the slots that words of at least MIN_DOCS documents use, else 0."""
    ends, count = np.append(starts, len(slots)), np.zeros((SLOTS, 1), np.float32)
    for _, index in docs:
        own = np.unique(index[index >= 0])
        sizes = ends[own + 1] - ends[own]
        at = np.repeat(ends[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        count[np.unique(slots[at])] += 1
    return (count >= MIN_DOCS).astype(np.float32)


def train(samples: list[tuple[int, list[str]]], seed: int = 0) -> dict[str, np.ndarray] | None:
    """``samples``: (label, windows as texts).  None without both labels."""
    samples = [(y, w) for y, w in samples if w]
    if len({y for y, _ in samples}) < 2:
        return None
    seen: dict[bytes, int] = {}
    docs = []
    for y, texts in samples:
        index = np.full((WINDOW, len(texts)), -1, dtype=np.int32)
        for k, text in enumerate(texts):
            own = [seen.setdefault(w, len(seen)) for w in text.encode("utf-8", "surrogatepass").split()]
            index[:len(own), k] = own
        docs.append((y, index))
    slots, grams, starts = _inputs(list(seen))
    ends = np.append(starts, len(grams))
    rng, model = np.random.default_rng(seed), new_model(seed)
    known = {k: _frequent(docs, v, s) for k, v, s in (
        ("word", slots, np.arange(len(slots))), ("char", grams, starts))}
    for k, mask in known.items():
        model[k] *= mask
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    by_label = [[d for d in docs if d[0] == y] for y in (0, 1)]
    turns = [iter(()), iter(())]

    def draw(y: int):
        k = next(turns[y], None)
        if k is None:  # the class is through: begin again in another order
            turns[y] = iter(rng.permutation(len(by_label[y])))
            k = next(turns[y])
        return by_label[y][k]

    for step in range(1, STEPS + 1):
        part = [draw(k % 2) for k in range(DOCS_A_STEP)]
        g = {k: np.zeros_like(v) for k, v in model.items()}
        edges = np.cumsum([x.shape[1] for _, x in part]) // GROUP
        for few in (part[a:b] for a, b in itertools.pairwise([0, *np.flatnonzero(np.diff(edges)) + 1, len(part)])):
            labels = np.array([y for y, _ in few])
            doc_of = np.repeat(np.arange(len(few)), [x.shape[1] for _, x in few])
            index = np.concatenate([x for _, x in few], axis=1)
            used, back = np.unique(index, return_inverse=True)
            shift = int(used[0] == -1)
            used, index = used[shift:], back.reshape(index.shape) - shift
            own = [np.arange(starts[w], ends[w + 1]) for w in used]
            own_grams = grams[np.concatenate(own)]
            sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
            own_starts = np.cumsum(sizes) - sizes
            x = _embed(model, (slots[used], own_grams, own_starts))
            _, some, d_x = _gradients(model, x, index, doc_of, labels, len(part))
            for k, v in some.items():
                g[k] += v
            np.add.at(g["word"], slots[used], d_x[:, :DIM])
            np.add.at(g["char"], own_grams, np.repeat(d_x[:, DIM:] / sizes[:, None], sizes, axis=0))
        for k, mask in known.items():
            g[k] *= mask
        for k, v in model.items():  # Adam
            first[k] += 0.1 * (g[k] - first[k])
            second[k] += 0.01 * (g[k] ** 2 - second[k])
            v -= (RATE * (first[k] / (1 - 0.9 ** step))
                  / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return model


def sample_windows(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS,
                   max_windows: int = MAX_WINDOWS) -> list[tuple[int, list[str]]]:
    """The bounded training sample: at most 2 x ``max_docs`` documents (the ids are
    picked from the slim labels first) of at most ``max_windows`` windows each."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
             .groupBy("doc_id").agg(F.max("toxic").alias("y")).filter(~is_held_out()))
    some = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
            for y in (0, 1)]

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                words = _words(text)
                at = _windows(len(words))
                if len(at) > max_windows:
                    at = at[np.linspace(0, len(at) - 1, max_windows).astype(int)]
                out.append([b" ".join(words[k:k + WINDOW]).decode("utf-8", "replace") for k in at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(out, pa.list_(pa.string()))], names=["y", "windows"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(some[0].unionByName(some[1])), "doc_id")
    # labels may name a document that stands in several rows: one of them, so that at most
    # max_docs rows a class are collected
    one = F.min(F.struct(F.xxhash64("doc_id", "text").alias("h"), "text"))
    rows = chosen.groupBy("doc_id", "y").agg(one.alias("one")).select("y", "one.text")
    rows = rows.mapInArrow(cut, "y int, windows array<string>").collect()
    return sorted((int(r["y"]), list(r["windows"])) for r in rows)


# --------------------------------------------------------------------- scoring


def _score(model, text_col: str):
    def run(batches):
        import pyarrow as pa

        for part in slices(batches, text_col):
            seen: dict[bytes, int] = {}
            ids, spans = [], []
            for text in part.column(text_col).to_pylist():
                words = _words(text)
                spans.append((len(ids), len(words)))
                ids += [seen.setdefault(w, len(seen)) for w in words]
            score = np.zeros(len(spans))
            if model is not None and ids:
                gates = _gates(model, _embed(model, _inputs(list(seen))))
                ids = np.array(ids, dtype=np.int64)
                starts = [_windows(n) for _, n in spans]
                doc_of = np.repeat(np.arange(len(spans)), [len(s) for s in starts])
                first = np.concatenate(starts) + np.array([a for a, _ in spans])[doc_of]
                end = np.array([a + n for a, n in spans])[doc_of]
                for k in range(0, len(first), BATCH):
                    at = first[k:k + BATCH] + np.arange(WINDOW)[:, None]
                    index = np.where(at < end[k:k + BATCH], ids[np.minimum(at, len(ids) - 1)], -1)
                    p = _sigmoid(_forward(model, gates, index).astype(np.float64))
                    np.maximum.at(score, doc_of[k:k + BATCH], p)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)],
                                             names=[*part.schema.names, SCORE])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)``, ``labels(doc_id, toxic)`` -> all columns of ``docs``
    plus ``__score`` (0 to 1, higher: likelier toxic)."""
    model = train(sample_windows(docs, labels))
    text_col = next(c for c in docs.columns if c.lower() == "text")
    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])
    return docs.mapInArrow(_score(model, text_col), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    return score_toxicity(docs, labels).filter(F.col(SCORE) < threshold).drop(SCORE)
