"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is a sequence of words (A-Z in lower case, runs without ASCII punctuation or
space). A word's input is the sum of two hashed word embeddings and the means of the
hashed embeddings of its runs of three and of five bytes, spaces around it included, so
that forms of one stem are alike. Windows of ``WINDOW`` words, each overlapping the
next, run through the network one by one; a text's score is that of its most toxic
window, calibrated on labelled texts.

Training sees windows of a bounded sample of labelled rows whose crc32(doc_id) mod 5 is
not 0; the others are held out. Windows of a toxic text that look harmless beside its
most toxic one are left out as training goes on, as its label need not hold for each.

Rows: null and empty texts are one window without words; null ids are not held out and
never train; rows of one id are scored one by one; without labels of both kinds every
score is the share of toxic labels (0 without any); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.tables import map_batches, records

WINDOW = 64
STRIDE = 48
#: Training sample: labelled rows of each kind, windows of each row, windows of harmless
#: and of toxic rows, and the least number of harmless ones in an epoch.
SAMPLE_ROWS = 2_000
ROW_WINDOWS = 12
SAMPLE_WINDOWS = (8_000, 4_000)
EPOCH_WINDOWS = 2_000

WORD_SLOTS = 1 << 15
CHAR_SLOTS = 1 << 16
WIDTH = 12
UNITS = 8
EPOCHS = 6
MASKED = 0.5
BATCH = 64
#: Windows that are scored together, and words whose spelling is averaged together.
SCORE_BATCH = 1024
MEAN_BATCH = 8192

Weights = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Vocabulary:
    """The distinct words of a chunk: their places in the hashed tables."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        _, first, self.of = np.unique(hashes, return_index=True, return_inverse=True)
        hashes = hashes[first]
        low = np.uint64(WORD_SLOTS - 1)
        self.one = (hashes & low).astype(np.int64)
        self.two = ((hashes >> np.uint64(32)) & low).astype(np.int64)
        distinct = T.Words(starts[first], ends[first], np.array([0, len(first)]))
        spelled, self.begin = T.joined(data, distinct) if len(first) else (np.zeros(0, np.uint8), first)
        spelled = np.where(spelled == 0x0A, 0x20, spelled).astype(np.uint64)
        around = np.concatenate([[0x20, 0x20], spelled, [0x20, 0x20]]).astype(np.uint64)
        near = [around[place : place + len(spelled)] for place in range(5)]
        for outer, inner in ((0, 1), (4, 3)):  # the next word begins there
            near[outer] = np.where(near[inner] == 0x20, np.uint64(0x20), near[outer])
        code = np.full(len(spelled), 1, np.uint64)
        for place in (1, 2, 3, 0, 4):
            code = code << np.uint64(8) | near[place]
            if place == 3:
                three = T.mix(code)
        slots = np.uint64(CHAR_SLOTS - 1)
        #: For each byte, the slots of the runs of three and five bytes around it.
        self.chars = np.stack([three & slots, T.mix(code) & slots], axis=1).astype(np.int64)
        self.lengths = distinct.ends - distinct.starts

    def mean_of_chars(self, table: np.ndarray) -> np.ndarray:
        """The means of each word's rows, some words at a time. The space after a word
        belongs to no word."""
        found = np.zeros((len(self.begin), table.shape[1]), np.float32)
        for low in range(0, len(self.begin), MEAN_BATCH):
            words = slice(low, low + MEAN_BATCH)
            begin, lengths = self.begin[words], self.lengths[words]
            own = self.chars[begin[0] : begin[-1] + lengths[-1]]
            total = np.zeros((len(own) + 1, table.shape[1]), np.float64)
            np.cumsum(table[own[:, 0]] + table[own[:, 1]], axis=0, out=total[1:])
            at = begin - begin[0]
            found[words] = (total[at + lengths] - total[at]) / lengths[:, None]
        return found

    def embed(self, w: Weights) -> np.ndarray:
        return w["word1"][self.one] + w["word2"][self.two] + self.mean_of_chars(w["char"])


def vocabulary(texts: list[bytes]) -> tuple[Vocabulary, np.ndarray]:
    """Of a list of texts, hashed a chunk at a time, with the word at which each begins."""
    data, starts, ends, hashes, rows, at = [], [], [], [], [np.zeros(1, np.int64)], 0
    for chunk in T.chunks(pa.array([t.decode() for t in texts], pa.large_string())):
        found = T.words(chunk, T.ALNUM)
        data.append(chunk.data)
        starts.append(found.starts + at)
        ends.append(found.ends + at)
        hashes.append(T.word_hashes(chunk.data, found))
        rows.append(found.rows[1:] + rows[-1][-1])
        at += len(chunk.data)
    whole = [np.concatenate(parts) for parts in (data, starts, ends, hashes)]
    return Vocabulary(*whole), np.concatenate(rows)


def windows(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and number of words of every window of texts of these sizes."""
    counts = np.maximum(1, -(-(n_words - (WINDOW - STRIDE)) // STRIDE))
    row = np.repeat(np.arange(len(n_words)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = nth * STRIDE
    return row, start, np.minimum(WINDOW, n_words[row] - start)


def grid(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of windows, one column each, and which cells hold a word."""
    step = np.arange(max(1, int(size.max(initial=1))))[:, None]
    held = step < size[None, :]
    return np.where(held, first[None, :] + step, 0), held


def initial(seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)
    both = 2 * UNITS

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return {
        "word1": np.zeros((WORD_SLOTS, WIDTH), np.float32),
        "word2": np.zeros((WORD_SLOTS, WIDTH), np.float32),
        "char": np.zeros((CHAR_SLOTS, WIDTH), np.float32),
        "inputs": normal(WIDTH, 3 * both, scale=WIDTH**-0.5),
        "bias": np.zeros(3 * both, np.float32),
        "state": normal(2, UNITS, 3 * UNITS, scale=UNITS**-0.5),
        "focus": normal(both, UNITS, scale=both**-0.5),
        "focus_bias": np.zeros(UNITS, np.float32),
        "pick": normal(UNITS, scale=UNITS**-0.5),
        "out": normal(both, scale=both**-0.5),
        "out_bias": np.zeros(1, np.float32),
    }


def _both_ways(state: np.ndarray) -> np.ndarray:
    """One matrix for both directions' states side by side: each only feeds its own gates."""
    whole = np.zeros((2 * UNITS, 3, 2 * UNITS), np.float32)
    for way in range(2):
        part = slice(way * UNITS, (way + 1) * UNITS)
        whole[part, :, part] = state[way].reshape(UNITS, 3, UNITS)
    return whole.reshape(2 * UNITS, 6 * UNITS)


def _read(projected: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Gate inputs (step, window, gate, unit): forward units at the step, backward at its mirror."""
    x = projected.reshape(-1, 3, 2 * UNITS)
    return np.concatenate([x[:, :, :UNITS][at], x[:, :, UNITS:][at[::-1]]], axis=3)


class Run:
    """One forward run over a grid of windows; ``keep`` holds what the backward run needs."""

    def __init__(self, w: Weights, x: np.ndarray, held: np.ndarray, keep: bool = False):
        steps, n = held.shape
        both, recurrent = 2 * UNITS, _both_ways(w["state"])
        h = np.zeros((n, both), np.float32)
        self.before, self.gates = [], []
        states = np.empty((steps, n, both), np.float32)
        full = held.all()
        for t in range(steps):
            a = h @ recurrent
            zr = _sigmoid(x[t, :, :2].reshape(n, 2 * both) + a[:, : 2 * both])
            z, r = zr[:, :both], zr[:, both:]
            inner = a[:, 2 * both :]
            c = np.tanh(x[t, :, 2] + r * inner)
            if keep:
                self.before.append(h)
                self.gates.append((z, r, inner, c))
            new = c + z * (h - c)
            if not full:
                here = np.concatenate(
                    [np.repeat(held[t][:, None], UNITS, 1), np.repeat(held[steps - 1 - t][:, None], UNITS, 1)], 1
                )
                new = np.where(here, new, h)
            h = new
            states[t, :, :UNITS] = h[:, :UNITS]
            states[steps - 1 - t, :, UNITS:] = h[:, UNITS:]
        self.states = states
        self.inner = np.tanh(states.reshape(-1, both) @ w["focus"] + w["focus_bias"]).reshape(steps, n, UNITS)
        energy = np.where(held, self.inner @ w["pick"], -1e9)
        energy = np.exp(energy - energy.max(0)) * held
        self.share = energy / np.maximum(energy.sum(0), 1e-9)
        self.pooled = np.einsum("tn,tnk->nk", self.share, states)
        self.logit = self.pooled @ w["out"] + w["out_bias"]


def gradients(w: Weights, x: np.ndarray, held: np.ndarray, run: Run, slope: np.ndarray) -> tuple[Weights, np.ndarray]:
    """Gradients of the summed loss, whose slope by logit is given, and of the gate inputs."""
    steps, n = held.shape
    both, recurrent = 2 * UNITS, _both_ways(w["state"])
    g = {"out": run.pooled.T @ slope, "out_bias": slope.sum(keepdims=True)}
    d_pooled = slope[:, None] * w["out"]
    d_states = run.share[:, :, None] * d_pooled[None]
    d_share = np.einsum("tnk,nk->tn", run.states, d_pooled)
    d_energy = run.share * (d_share - (run.share * d_share).sum(0))
    g["pick"] = np.einsum("tn,tnk->k", d_energy, run.inner)
    d_inner = d_energy[:, :, None] * w["pick"] * (1 - run.inner**2)
    g["focus"] = run.states.reshape(-1, both).T @ d_inner.reshape(-1, UNITS)
    g["focus_bias"] = d_inner.sum((0, 1))
    d_states += d_inner @ w["focus"].T
    d_x = np.zeros_like(x)
    d_recurrent = np.zeros_like(recurrent)
    d_h = np.zeros((n, both), np.float32)
    for t in range(steps - 1, -1, -1):
        d_h[:, :UNITS] += d_states[t, :, :UNITS]
        d_h[:, UNITS:] += d_states[steps - 1 - t, :, UNITS:]
        here = np.concatenate(
            [np.repeat(held[t][:, None], UNITS, 1), np.repeat(held[steps - 1 - t][:, None], UNITS, 1)], 1
        )
        z, r, inner, c = run.gates[t]
        h, d_new = run.before[t], d_h * here
        d_c = d_new * (1 - z) * (1 - c**2)
        d_z = d_new * (h - c) * z * (1 - z)
        d_r = d_c * inner * r * (1 - r)
        d_a = np.concatenate([d_z, d_r, d_c * r], 1)
        d_x[t, :, 0], d_x[t, :, 1], d_x[t, :, 2] = d_z, d_r, d_c
        d_recurrent += h.T @ d_a
        d_h = d_h * ~here + d_new * z + d_a @ recurrent.T
    parts = d_recurrent.reshape(2, UNITS, 3, 2, UNITS)
    g["state"] = np.stack([parts[way, :, :, way].reshape(UNITS, 3 * UNITS) for way in range(2)])
    return g, d_x


def logits(w: Weights, vocabulary: Vocabulary, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The network's output for every window, a bounded number at a time, long ones apart."""
    projected = vocabulary.embed(w) @ w["inputs"] + w["bias"] if len(vocabulary.one) else np.zeros((1, 6 * UNITS), np.float32)
    of = vocabulary.of if len(vocabulary.of) else np.zeros(1, np.int64)
    found = np.empty(len(first), np.float32)
    order = np.argsort(-size, kind="stable")
    for low in range(0, len(order), SCORE_BATCH):
        part = order[low : low + SCORE_BATCH]
        at, held = grid(first[part], size[part])
        found[part] = Run(w, _read(projected, of[at]), held).logit
    return found


def train(texts: list[bytes], labels: np.ndarray, groups: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Weights:
    """Fit on windows (words joined by spaces), their texts' labels and numbers, by Adam.

    From the second epoch on, a toxic text's windows that look harmless are left out,
    but not its most toxic one. Of the harmless texts' windows each epoch takes as many
    as of the others and at least ``EPOCH_WINDOWS``, half of them those that score most.
    Whole words are masked at random, so that their spelling is learned too.
    """
    w = initial(seed)
    rng = np.random.default_rng(seed)
    words, rows = vocabulary(texts)
    first, size = rows[:-1], np.diff(rows)
    spelled = np.repeat(np.arange(len(words.begin)), words.lengths)
    places = np.arange(len(spelled)) - np.repeat(np.cumsum(words.lengths) - words.lengths, words.lengths) + words.begin[spelled]
    slots = words.chars[places]
    first_moment = {k: np.zeros_like(v) for k, v in w.items()}
    second_moment = {k: np.zeros_like(v) for k, v in w.items()}
    beat = 0
    harmless = np.flatnonzero(labels == 0)
    for epoch in range(epochs):
        use = labels == 1
        taken = min(len(harmless), max(EPOCH_WINDOWS, int(use.sum())))
        use[rng.permutation(harmless)[:taken]] = True
        if epoch:
            scores = logits(w, words, first, size)
            best = np.full(int(groups.max()) + 1, -np.inf)
            np.maximum.at(best, groups, scores)
            use = (labels == 1) & ((scores > 0) | (scores >= best[groups]))
            use[harmless[np.argsort(-scores[harmless], kind="stable")[: taken // 2]]] = True
            use[rng.permutation(harmless)[: taken - taken // 2]] = True
        order = rng.permutation(np.flatnonzero(use))
        weight = np.where(labels == 1, 0.5 / max(1, (use & (labels == 1)).sum()), 0.5 / max(1, (use & (labels == 0)).sum()))
        weight = (weight * use.sum()).astype(np.float32)
        for low in range(0, len(order), BATCH):
            part = order[low : low + BATCH]
            at, held = grid(first[part], size[part])
            used, local = np.unique(words.of[at], return_inverse=True)
            shown = (rng.random((len(used), 1)) > MASKED).astype(np.float32)
            embedded = shown * (w["word1"][words.one[used]] + w["word2"][words.two[used]])
            mine = np.isin(spelled, used)
            owner = np.searchsorted(used, spelled[mine])
            share = (1.0 / words.lengths[used])[:, None].astype(np.float32)
            chars = np.zeros_like(embedded)
            near = slots[mine]
            np.add.at(chars, owner, w["char"][near[:, 0]] + w["char"][near[:, 1]])
            embedded = embedded + chars * share
            x = _read(embedded @ w["inputs"] + w["bias"], local.reshape(at.shape))
            run = Run(w, x, held, keep=True)
            slope = (weight[part] * (_sigmoid(run.logit) - labels[part]) / len(part)).astype(np.float32)
            g, d_x = gradients(w, x, held, run, slope)
            d_projected = np.zeros((len(used), 3, 2 * UNITS), np.float32)
            flat = local.reshape(at.shape)
            np.add.at(d_projected[:, :, :UNITS], flat, d_x[:, :, :, :UNITS])
            np.add.at(d_projected[:, :, UNITS:], flat[::-1], d_x[:, :, :, UNITS:])
            d_projected = d_projected.reshape(len(used), 6 * UNITS)
            g["inputs"], g["bias"] = embedded.T @ d_projected, d_projected.sum(0)
            d_embedded = d_projected @ w["inputs"].T
            for name in ("word1", "word2", "char"):
                g[name] = np.zeros_like(w[name])
            np.add.at(g["word1"], words.one[used], d_embedded * shown)
            np.add.at(g["word2"], words.two[used], d_embedded * shown)
            d_chars = (d_embedded * share)[owner]
            for k in range(2):
                np.add.at(g["char"], near[:, k], d_chars)
            beat += 1
            for name, slope_of in g.items():
                m, v = first_moment[name], second_moment[name]
                m += 0.1 * (slope_of - m)
                v += 0.01 * (slope_of**2 - v)
                step = m / (1 - 0.9**beat) / (np.sqrt(v / (1 - 0.99**beat)) + 1e-6)
                w[name] -= 0.01 * step
    return w


def calibrate(scores: np.ndarray, labels: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Scale and offset that turn texts' logits into probabilities.

    The scale is that of a logistic fit in which both kinds weigh alike; 0.5 lies where
    the two shares of right verdicts add up to the most, in the middle of the best gap.
    """
    order = np.argsort(scores, kind="stable")
    ranked, toxic = scores[order], labels[order] == 1
    missed = np.concatenate([[0], np.cumsum(toxic)]) / max(1, toxic.sum())
    alarms = 1 - np.concatenate([[0], np.cumsum(~toxic)]) / max(1, (~toxic).sum())
    best = int(np.argmin(missed + alarms))
    middle = float(ranked[max(0, best - 1)] + ranked[min(best, len(ranked) - 1)]) / 2
    centre, spread = float(scores.mean()), float(scores.std()) or 1.0
    x = (scores - centre) / spread
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        pull, curve = weight * (p - labels), weight * np.maximum(p * (1 - p), 1e-6)
        da, db = (pull * x).sum() + 1e-3 * (a - 1), pull.sum()
        haa, hab, hbb = (curve * x * x).sum() + 1e-3, (curve * x).sum(), curve.sum() + 1e-6
        det = haa * hbb - hab * hab
        a, b = a - (hbb * da - hab * db) / det, b - (haa * db - hab * da) / det
    scale = max(a, 1e-3) / spread
    return scale, -scale * middle


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Weights and calibration from ``labels`` (doc_id, toxic), or the share of toxic ones.

    At most ``sample_rows`` ids of each kind, in the order of a hash, and ``ROW_WINDOWS``
    windows of each text reach the driver.
    """
    marked = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
        .filter(remainder(F.col("doc_id")) != 0)
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    kinds = [marked.filter(F.col("_toxic") == k).orderBy(*order).limit(sample_rows) for k in (0, 1)]
    sample = kinds[0].unionAll(kinds[1])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = rows.join(F.broadcast(sample), "doc_id")
    table = map_batches(rows.select("doc_id", "_toxic", "text"), _sampled, "doc_id bigint, toxic int, part int, words binary")
    seen = table.toPandas().sort_values(["doc_id", "part", "words"], kind="stable")
    toxic = seen["toxic"].to_numpy()
    if not len(seen) or toxic.min() == toxic.max():
        return {"share": float(toxic.mean()) if len(seen) else 0.0}
    rng = np.random.default_rng(1)
    chosen = np.sort(np.concatenate([rng.permutation(np.flatnonzero(toxic == k))[: SAMPLE_WINDOWS[k]] for k in (0, 1)]))
    words = list(seen["words"])
    groups = np.unique(seen["doc_id"].to_numpy()[chosen], return_inverse=True)[1]
    w = train([words[i] for i in chosen], toxic[chosen].astype(np.float32), groups)
    scores = np.zeros(len(words), np.float32)
    for low in range(0, len(words), SCORE_BATCH):
        own, begin = vocabulary(words[low : low + SCORE_BATCH])
        scores[low : low + SCORE_BATCH] = logits(w, own, begin[:-1], np.diff(begin))
    best = seen.assign(score=scores).groupby("doc_id").agg(score=("score", "max"), toxic=("toxic", "max"))
    scale, offset = calibrate(best["score"].to_numpy(float), best["toxic"].to_numpy())
    return {"weights": w, "scale": scale, "offset": offset}


def _sampled(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids, toxic, parts, found = [], [], [], []
    for chunk in T.chunks(batch.column(2)):
        lower = chunk._replace(data=T.LOWER[chunk.data])
        words = T.words(lower, T.ALNUM)
        row, start, size = windows(np.diff(words.rows))
        spelled, begin = T.joined(lower.data, words)
        raw = spelled.tobytes()
        ends = begin + (words.ends - words.starts)
        for r in range(len(words.rows) - 1):
            own = np.flatnonzero(row == r)
            own = own[np.unique(np.linspace(0, len(own) - 1, ROW_WINDOWS).round().astype(int))]
            for i in own.tolist():
                if size[i] > 0:
                    a = words.rows[r] + start[i]
                    ids.append(batch.column(0)[chunk.first + r].as_py())
                    toxic.append(batch.column(1)[chunk.first + r].as_py())
                    parts.append(i - int(own[0]))
                    found.append(raw[begin[a] : ends[a + size[i] - 1]])
    yield records(
        doc_id=pa.array(ids, pa.int64()),
        toxic=pa.array(toxic, pa.int32()),
        part=pa.array(parts, pa.int32()),
        words=pa.array(found, pa.binary()),
    )


def score_texts(model: dict, chunk: T.Chunk) -> np.ndarray:
    """Each row's probability: that of its most toxic window."""
    n = len(chunk.bounds) - 1
    if "weights" not in model:
        return np.full(n, model["share"])
    chunk = chunk._replace(data=T.LOWER[chunk.data])
    found = T.words(chunk, T.ALNUM)
    row, start, size = windows(np.diff(found.rows))
    vocabulary = Vocabulary(chunk.data, found.starts, found.ends, T.word_hashes(chunk.data, found))
    scores = logits(model["weights"], vocabulary, found.rows[row] + start, size)
    best = np.full(n, -np.inf)
    np.maximum.at(best, row, scores)
    return 1 / (1 + np.exp(-np.clip(model["scale"] * best + model["offset"], -30, 30)))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [score_texts(shared.value, chunk) for chunk in T.chunks(batch.column(1))]
        if found:
            yield records(doc_id=batch.column(0), score=np.concatenate(found))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = map_batches(rows, step, "doc_id bigint, score double")
    held = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
