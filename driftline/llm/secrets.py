"""Secret scans: fixed patterns, and a character convolution over every other long token with its context.

The patterns give the base findings. Every run of 16 or more token characters that no base finding covers is a candidate; a
small convolutional network in numpy reads it with the text around it. The network is trained on all labelled findings
(what the patterns found against other candidates) of all documents, every piece of them in every context: in rounds on Spark, where parts of the findings
are descended side by side from one network and the networks are averaged. Its output is calibrated on the findings kept
back, and the threshold is the highest that keeps the wanted recall there, however low; the network states its recall and precision.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.quantile import quantiles
from driftline.functions.sizing import store
from driftline.llm.registry import query, ready, table, widened

KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile("(" + "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")
                    + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]{24,}")
CANDIDATE = re.compile("[A-Za-z0-9+/_=-]{16,}")
KINDS = ("assign", "access", "hex", "model")
LEAST_LONG = 16

BEFORE, BODY, AFTER = 24, 64, 8             # letters of context and of the candidate that the network sees at once
STRIDE = 48                                 # longer candidates are read in overlapping pieces; the highest counts
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-.\"':;,|()[]{}<>#$%&!? \n"
CODES = {c: i + 2 for i, c in enumerate(LETTERS)}         # 0: outside the text, 1: any other letter
N_CODES = len(LETTERS) + 2
RECALL = 0.98
PART, PASSES = 4_096, 2                     # rows that one task descends in a round, and how often it meets each
FIXED = float(1 << 40)                      # networks are added up as whole numbers, so their order makes no difference
DIM, WIDTH, FILTERS, EPOCHS, RATE = 8, 5, 24, 8, 0.004


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of the base findings, by start, then by kind as listed."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]      # runs are taken whole, so 24 and more in one go
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Long token runs that no base finding touches."""
    out, spans, i = [], sorted((s, e) for _, s, e in base), 0
    for m in CANDIDATE.finditer(text):
        while i < len(spans) and spans[i][1] <= m.start():
            i += 1
        if not any(s < m.end() and e > m.start() for s, e in spans[i:i + 3]):
            out.append((m.start(), m.end()))
    return out


def has_long_run(text: str) -> bool:
    """Whether any stretch without white space is long enough for anything but an assignment."""
    return any(len(w) >= LEAST_LONG for w in text.split())


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Code rows of a candidate: left context, body, right context, with the body's codes moved up by ``N_CODES``."""
    out = []
    for at in range(start, max(start + 1, end - BODY + STRIDE), STRIDE):
        to = min(end, at + BODY)
        row = np.zeros(BEFORE + BODY + AFTER, np.int16)
        left, right = text[max(0, at - BEFORE):at], text[to:to + AFTER]
        row[BEFORE - len(left):BEFORE] = [CODES.get(c, 1) for c in left]
        row[BEFORE:BEFORE + to - at] = [N_CODES + CODES.get(c, 1) for c in text[at:to]]
        row[BEFORE + BODY:BEFORE + BODY + len(right)] = [CODES.get(c, 1) for c in right]
        out.append(row)
    return out


class Network(NamedTuple):
    embed: np.ndarray       # (2 * N_CODES, DIM)
    conv: np.ndarray        # (WIDTH * DIM, FILTERS)
    conv_bias: np.ndarray
    dense: np.ndarray       # (2 * FILTERS,): of the largest and of the mean response
    bias: np.ndarray
    slope: float = 1.0      # calibration: probability = sigmoid(slope * output + shift)
    shift: float = 0.0
    threshold: float = 2.0  # above any probability: without training nothing is added
    recall: float = 0.0     # at the threshold, of the findings kept back
    precision: float = 0.0


def forward(net: Network, rows: np.ndarray):
    x = net.embed[rows]
    n, length, _ = x.shape
    steps = length - WIDTH + 1
    cols = np.concatenate([x[:, k:k + steps] for k in range(WIDTH)], axis=2)
    z = np.maximum(cols @ net.conv + net.conv_bias, 0)
    top = z.argmax(axis=1)
    pooled = np.concatenate([np.take_along_axis(z, top[:, None], 1)[:, 0], z.mean(axis=1)], axis=1)
    return pooled @ net.dense + net.bias[0], (cols, z, top, pooled)


def gradients(net: Network, rows: np.ndarray, slope_out: np.ndarray, kept) -> list[np.ndarray]:
    cols, z, top, pooled = kept
    n, steps, f = z.shape
    d_pool = slope_out[:, None] * net.dense
    d_z = np.repeat(d_pool[:, None, f:] / steps, steps, axis=1)
    np.put_along_axis(d_z, top[:, None], np.take_along_axis(d_z, top[:, None], 1) + d_pool[:, None, :f], 1)
    d_z *= z > 0
    d_cols = d_z @ net.conv.T
    d_x, d_embed = np.zeros((n, rows.shape[1], DIM)), np.zeros_like(net.embed)
    for k in range(WIDTH):
        d_x[:, k:k + steps] += d_cols[:, :, k * DIM:(k + 1) * DIM]
    np.add.at(d_embed, rows, d_x)
    return [d_embed, np.einsum("nsc,nsf->cf", cols, d_z, optimize=True), d_z.sum((0, 1)), pooled.T @ slope_out, np.array([slope_out.sum()])]


def probabilities(net: Network, rows: np.ndarray) -> np.ndarray:
    out = [forward(net, rows[i:i + 512])[0] for i in range(0, len(rows), 512)]
    z = np.concatenate(out) if out else np.empty(0)
    return 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -30, 30)))


def held_back(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Whether each row is kept back: every fifth finding of a label in hash order, with all rows of that finding whatever their context."""
    bodies, of = np.unique(rows[:, BEFORE:BEFORE + BODY], axis=0, return_inverse=True)
    of = of.reshape(-1)
    good = np.zeros(len(bodies), bool)
    good[of[labels == 1]] = True
    order = np.argsort([zlib.crc32(b.tobytes()) for b in bodies], kind="stable").astype(int)
    held = np.zeros(len(bodies), bool)
    for kind in (order[good[order]], order[~good[order]]):
        held[kind[::5]] = True
    return held[of]


def fresh(rng) -> Network:
    return Network(rng.normal(0, 0.3, (2 * N_CODES, DIM)), rng.normal(0, 0.2, (WIDTH * DIM, FILTERS)), np.zeros(FILTERS),
                   rng.normal(0, 0.2, 2 * FILTERS), np.zeros(1))


def started(net: Network) -> tuple[Network, list[np.ndarray], list[np.ndarray]]:
    """A network with Adam's two means of its gradients, as they are before the first step."""
    return net, [np.zeros_like(a) for a in net[:5]], [np.zeros_like(a) for a in net[:5]]


def descend(state, t: int, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rng, epochs: int):
    """``state`` after Adam's steps over the rows, ``t`` steps having gone before."""
    net, m, v = state[0], list(state[1]), list(state[2])
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), 64):
            pick = order[i:i + 64]
            batch = x[pick].copy()
            blank = rng.random(len(pick)) < 0.5
            batch[blank] = np.where(batch[blank] >= N_CODES, batch[blank], 0)
            z, kept = forward(net, batch)
            slope_out = weight[pick] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
            t += 1
            new = []
            for k, (a, g) in enumerate(zip(net[:5], gradients(net, batch, slope_out, kept))):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                new.append(a - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8))
            net = Network(*new)
    return net, m, v


def train(rows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, recall: float = RECALL, seed: int = 7) -> Network:
    """Fit on four fifths of findings in memory, calibrate and set the threshold on the rest; ``fit`` does so for any number.

    Context is blanked in every second example, so that the network learns the token's own shape as well. With findings of one
    label only nothing can be told apart, and the network adds nothing.
    """
    rng = np.random.default_rng(seed)
    net = fresh(rng)
    held = held_back(rows, labels)
    if min((labels[~held] == 1).sum(), (labels[~held] == 0).sum(), (labels[held] == 1).sum()) == 0:
        return net
    x, y = rows[~held], labels[~held].astype(float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    net = descend(started(net), 0, x, y, weight, rng, epochs)[0]
    z, y = forward(net, rows[held])[0], labels[held].astype(float)
    slope, shift = 1.0, 0.0
    for _ in range(200):                    # Platt's sigmoid by gradient steps, a little held back
        p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
        slope -= 0.1 * (((p - y) * z).mean() + 0.01 * (slope - 1))
        shift -= 0.1 * (p - y).mean()
    net = net._replace(slope=float(slope), shift=float(shift))
    p = probabilities(net, rows[held])
    good = np.sort(p[y == 1])
    threshold = float(good[int((1 - recall) * len(good))])
    found = p >= threshold
    return net._replace(threshold=threshold, recall=float(found[y == 1].mean()), precision=float(y[found].mean()))


LENGTH = BEFORE + BODY + AFTER


def unpacked(column) -> np.ndarray:
    """Code rows of a binary Arrow column."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int16).reshape(-1, LENGTH)


def all_findings(docs: DataFrame) -> DataFrame:
    """(x, y, of, weight, held, part): every piece of every finding in ``docs`` in each of its contexts, with its label.

    Equal rows count once. ``of`` names the finding; its rows share a weight of one, so a common one is no more than another, and are kept back (about every
    fifth finding, by hash) or learnt from together. ``part`` deals rows evenly over parts of about ``PART``.
    """
    ready(docs.sparkSession)

    def label(batches):
        for batch in batches:
            for text in batch.column(0):            # pieces of one text at a time
                t, xs, ys, of = text.as_py(), [], [], []
                if not t or not has_long_run(t):
                    continue
                base = base_spans(t)
                spans = []
                for kind, s, e in base:
                    if kind == "assign":                            # the value, without the keyword
                        s += ASSIGN.match(t[s:e]).start(2)
                    if e - s >= LEAST_LONG:
                        spans.append((s, e, 1))
                for s, e, y in spans + [(s, e, 0) for s, e in candidates(t, base)]:
                    pieces = [w.tobytes() for w in windows(t, s, e)]
                    xs += pieces
                    ys += [y] * len(pieces)
                    of += [hashlib.md5(t[s:e].encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()] * len(pieces)
                yield pa.record_batch([pa.array(xs, pa.binary()), pa.array(ys, pa.int32()), pa.array(of, pa.binary())], names=["x", "y", "of"])

    seen = store(docs.select("text").mapInArrow(label, "x binary, y int, of binary").distinct())
    parts = max(1, -(-seen.count() // PART))
    sizes = seen.groupBy("of", "y").agg(F.count("*").alias("_n"))
    rows = seen.join(sizes, ["of", "y"]).withColumn("weight", 1 / F.col("_n")).drop("_n")
    return store(rows.withColumn("held", F.pmod(F.xxhash64(F.lit("held"), "of"), F.lit(5)) == 0)
                 .withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "x", "y"), F.lit(parts))))


def packed(state) -> np.ndarray:
    return np.concatenate([a.ravel() for part in (state[0][:5], state[1], state[2]) for a in part])


def opened(flat: np.ndarray, like):
    at, out = 0, []
    for part in (like[0][:5], like[1], like[2]):
        out.append([])
        for a in part:
            out[-1].append(flat[at:at + a.size].reshape(a.shape))
            at += a.size
    return Network(*out[0]), out[1], out[2]


def rounds(rows: DataFrame, sums: dict, epochs: int, seed: int) -> Network:
    """The network after all rows of ``rows`` were met ``epochs`` times, in rounds of ``PASSES``.

    A task descends from the round's network over one part; what comes of the parts is averaged by their sizes. The driver gets one
    network a round, whatever the number of parts.
    """
    state = started(fresh(np.random.default_rng(seed)))
    n, good, bad = sums["n"], sums["good"], sums["bad"]
    steps = max(1, round(n / sums["parts"] / 64))

    def learner(state, r: int, passes: int):
        def learn(table):
            table = table.sort_by([("x", "ascending"), ("y", "ascending")])
            y, w = table.column("y").to_numpy().astype(float), table.column("weight").to_numpy()
            w = w * np.where(y == 1, n / (2 * good), n / (2 * bad))
            rng = np.random.default_rng([seed, r, table.column("part")[0].as_py()])
            got = packed(descend(state, r * PASSES * steps, unpacked(table.column("x")), y, w, rng, passes))
            return pa.table({"at": pa.array(np.arange(len(got))), "v": pa.array(np.rint(got * (len(y) / n) * FIXED).astype(np.int64))})
        return learn

    for r, passes in enumerate([PASSES] * (epochs // PASSES) + [epochs % PASSES] * (epochs % PASSES > 0)):
        moved = rows.groupBy("part").applyInArrow(learner(state, r, passes), "at long, v long").groupBy("at").agg(F.sum("v").alias("v")).collect()
        flat = np.zeros(len(moved))
        for m in moved:
            flat[m["at"]] = m["v"] / FIXED
        state = opened(flat, state)
    return state[0]


def fit(found: DataFrame, epochs: int = EPOCHS, recall: float = RECALL, seed: int = 7) -> Network:
    """``train`` for any number of findings: fitted on those of ``all_findings`` not kept back, calibrated on all others.

    If either fold lacks a label nothing can be told apart or checked, and the network adds nothing.
    """
    sides = {(r["held"], r["y"]): r for r in found.groupBy("held", "y").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    if not {(False, 0), (False, 1), (True, 1)} <= set(sides):
        return fresh(np.random.default_rng(seed))
    learnt = [sides[False, y] for y in (0, 1)]
    parts = found.agg(F.max("part")).first()[0] + 1
    net = rounds(found.where("not held"), {"n": learnt[0]["n"] + learnt[1]["n"], "bad": learnt[0]["w"], "good": learnt[1]["w"], "parts": parts}, epochs, seed)

    def outputs(batches):
        for batch in batches:
            z = [forward(net, rows)[0] for i in range(0, batch.num_rows, 512) for rows in [unpacked(batch.column(0).slice(i, 512))]]
            yield pa.record_batch([pa.array(np.concatenate(z) if z else np.empty(0), pa.float64()), batch.column(1), batch.column(2)], names=["z", "y", "w"])

    told = store(found.where("held").select("x", "y", "weight").mapInArrow(outputs, "z double, y int, w double"))
    slope, shift = 1.0, 0.0

    def chance():
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), slope * F.col("z") + shift))))

    for _ in range(8):                      # Platt's sigmoid by Newton's steps, a little held back
        p, z, w = chance(), F.col("z"), F.col("w")
        q = w * p * (1 - p)
        g = told.agg(F.sum(w), F.sum(w * (p - F.col("y")) * z), F.sum(w * (p - F.col("y"))), F.sum(q * z * z), F.sum(q * z), F.sum(q)).first()
        one, two, aa, ab, bb = (x / g[0] for x in g[1:])
        one, two, aa, bb = one + 0.01 * (slope - 1), two + 1e-4 * shift, aa + 0.01, bb + 1e-4
        det = aa * bb - ab * ab
        slope, shift = slope - (bb * one - ab * two) / det, shift - (aa * two - ab * one) / det
    scored = told.select(chance().alias("p"), "y", "w")
    good = sides[True, 1]["n"]
    rank = int((1 - recall) * good)
    least = quantiles(scored.where("y = 1"), [], "p", {"least": rank / max(1, good - 1)}).first()["least"] - 1e-9
    hits = scored.agg(F.sum(F.when(F.col("p") >= least, F.col("w") * F.col("y"))).alias("good"), F.sum(F.when(F.col("p") >= least, F.col("w"))).alias("all")).first()
    return net._replace(slope=slope, shift=shift, threshold=float(least), recall=hits["good"] / sides[True, 1]["w"], precision=hits["good"] / hits["all"])


def findings(docs: DataFrame, most: int = 2_000) -> tuple[np.ndarray, np.ndarray]:
    """For looking at what is learnt: code rows and labels of the first ``most`` findings a label in hash order, each in one context. Nothing is trained on these."""
    body = F.substring("x", 2 * BEFORE + 1, 2 * BODY)
    found = store(all_findings(docs).groupBy(body.alias("body"), "y").agg(F.min("x").alias("x")).withColumn("at", F.xxhash64("body")))
    rows = [r for y in (0, 1) for r in found.where(F.col("y") == y).orderBy("at", "x").limit(most).collect()]
    rows.sort(key=lambda r: (r["at"], r["x"]))
    return np.frombuffer(b"".join(r["x"] for r in rows), np.int16).reshape(len(rows), LENGTH), np.array([r["y"] for r in rows], np.int32)


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_sha256 and spans, replacing columns of these names; null texts are empty.

    ``spans`` lists base findings and those the network adds (kind ``model``) by start, in code points of the whole text.
    """
    ready(docs.sparkSession)
    new = {"n_assign": T.LongType(), "n_access": T.LongType(), "n_hex": T.LongType(), "base_sha256": T.StringType(), "spans": T.StringType()}
    docs = docs.drop(*new)
    at = docs.columns.index("text")

    def look(batches):
        for batch in batches:
            bases, asked, rows = [], [], []
            for i, t in enumerate(batch.column(at).to_pylist()):
                t = t or ""
                long = has_long_run(t)
                base = base_spans(t) if long or any(k in t.lower() for k in KEYWORDS) else []
                bases.append(base)
                for s, e in candidates(t, base) if long else ():
                    for row in windows(t, s, e):
                        asked.append((i, s, e))
                        rows.append(row)
            p = probabilities(net, np.array(rows)) if rows else []
            added = {k for k, x in zip(asked, p) if x >= net.threshold}
            spans = [list(b) for b in bases]
            for i, s, e in added:
                spans[i].append(("model", s, e))
            spans = [sorted(x, key=lambda k: (k[1], KINDS.index(k[0]))) for x in spans]
            counts = [pa.array([sum(k == kind for k, _, _ in b) for b in bases], pa.int64()) for kind in KINDS[:3]]
            digests = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in bases], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts, digests, pa.array(map(joined, spans), pa.string())], names=[*batch.schema.names, *new])

    return docs.mapInArrow(look, widened(docs.schema, **new))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``scan`` with a network trained on all findings in ``docs`` themselves."""
    return scan(docs, fit(all_findings(docs)))


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
