"""Language identification by levels.

Linear support vector machines over hashed byte trigrams tell language families
apart, each family from each other; within the family chosen, machines of one
language against one other decide. Where there are more than ``BRANCH``
families, or languages in one, those with like trigrams form groups, and groups
are told apart first; so the machines are in proportion to the languages, and
no language is left out. All are trained here, one Spark task a choice, on a
bounded sample of labelled rows; predictions read whole texts.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import each_text, stored_copy
from courtside.session import ship_package

FEATURES = 4096
# Rows a language learns from, about; chosen by a hash of doc_id.
SAMPLE_ROWS = 400
# Most families, languages or groups told apart at once, and languages' worth of rows that stand for a group.
BRANCH = 10
GROUP_LANGUAGES = 4
EPOCHS = 30
REGULAR = 1e-3
HELD_OUT_OF = 5
UNDETERMINED = "und"

# Families of common languages. Any other is a family of its own.
FAMILIES = {
    "germanic": "de en nl sv da no nb nn is af",
    "romance": "fr es pt it ro ca gl oc",
    "slavic": "ru uk be bg sr hr bs sl mk cs sk pl",
    "indic": "hi mr ne bn pa gu ur",
    "turkic": "tr az kk uz ky",
    "uralic": "fi et hu",
}

_LETTER = re.compile(r"[^\W\d_]")
_LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs.split()), f"only {lang}")


def features(text: str | None) -> np.ndarray | None:
    """Root shares of hashed byte trigrams of the lower-cased letters; None without a letter."""
    if not text or not _LETTER.search(text):
        return None
    letters = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS_ONLY).split())
    a = np.frombuffer(b" " + letters + b" ", np.uint8).astype(np.uint32)
    h = (a[:-2] * np.uint32(0x9E3779B1)) ^ (a[1:-1] * np.uint32(0x85EBCA77)) ^ (a[2:] * np.uint32(0xC2B2AE3D))
    h *= np.uint32(0x27D4EB2F)
    counts = np.bincount(h >> np.uint32(32 - FEATURES.bit_length() + 1), minlength=FEATURES)
    return np.sqrt(counts / len(h)).astype(np.float32)


def train_pair(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Averaged stochastic subgradient of the hinge loss; y is 1 or -1. Rows are taken in the order given."""
    n, d = x.shape
    rows = np.hstack([x, np.ones((n, 1), np.float32)])
    w, mean = np.zeros(d + 1), np.zeros(d + 1)
    rng, step, averaged = np.random.default_rng(0), 0, 0
    for epoch in range(EPOCHS):
        for i in rng.permutation(n):
            step += 1
            rate = 1 / (REGULAR * (step + 100))
            short = y[i] * (rows[i] @ w) < 1
            w *= 1 - rate * REGULAR
            if short:
                w += rate * y[i] * rows[i]
            if epoch >= EPOCHS // 2:
                averaged += 1
                mean += (w - mean) / averaged
    scale = np.abs(rows @ mean).mean() or 1.0
    return (mean[:-1] / scale).astype(np.float32), float(mean[-1] / scale)


def remainder():
    """crc32 of doc_id as text, modulo five; NULL without doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_OF


class Tree:
    """What is told apart at each node: names of other nodes, or languages.

    ``means`` are the mean features of languages; they are needed only where
    more than ``BRANCH`` names are to be put into groups.
    """

    def __init__(self, languages: list[str], means: dict[str, np.ndarray] | None = None):
        self.nodes: dict[str, list[str]] = {}
        self.under: dict[str, list[str]] = {}  # languages below a node
        families: dict[str, list[str]] = {}
        for lang in sorted(languages):
            families.setdefault(family_of(lang), []).append(lang)
            self.under[f"language {lang}"] = [lang]
        tops = []
        for family, langs in sorted(families.items()):
            names = [f"language {lang}" for lang in langs]
            tops.append(names[0] if len(names) == 1 else self._add(f"family {family}", names, means or {}))
        self.root = self._add("all", tops, means or {})

    def _add(self, node: str, names: list[str], means: dict[str, np.ndarray]) -> str:
        self.under[node] = [lang for name in names for lang in self.under[name]]
        if len(names) > BRANCH:
            groups = self._groups(names, means)
            names = [g[0] if len(g) == 1 else self._add(f"{node}/{k}", g, means) for k, g in enumerate(groups)]
        self.nodes[node] = names
        return node

    def _groups(self, names: list[str], means: dict[str, np.ndarray]) -> list[list[str]]:
        """``BRANCH`` groups of about the same size: the largest is halved along the direction in which its means differ most."""
        none = np.zeros(FEATURES)
        mean = {name: np.mean([means.get(lang, none) for lang in self.under[name]], axis=0) for name in names}
        groups = [names]
        while len(groups) < BRANCH:
            group = max(groups, key=len)
            groups.remove(group)
            x = np.stack([mean[name] for name in group])
            x = x - x.mean(0)
            along = x.T @ np.linalg.eigh(x @ x.T)[1][:, -1]
            along = along * np.sign(along[np.abs(along).argmax()] or 1)
            order = [group[k] for k in np.argsort((x @ along).round(9), kind="stable")]
            groups += [order[: len(order) // 2], order[len(order) // 2 :]]
        return [sorted(g) for g in groups]

    def uses(self, rows: dict[str, int], sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, str, int, float]]:
        """(language, node, place of the name it stands under, share of its rows that are used) of every choice.

        ``rows`` tells how many each language has. A group is learned from all of
        them, up to ``GROUP_LANGUAGES`` times what a language is learned from.
        """
        sampled = {lang: min(n, sample_rows) for lang, n in rows.items()}
        return [
            (lang, node, place, min(1.0, GROUP_LANGUAGES * sample_rows / max(1, sum(sampled[of] for of in self.under[name]))))
            for node, names in self.nodes.items()
            if len(names) > 1
            for place, name in enumerate(names)
            for lang in self.under[name]
        ]


class Model:
    """A tree, and a weight vector for each two names of each of its nodes."""

    def __init__(self, tree: Tree | None, weights: dict[tuple[str, int, int], tuple[np.ndarray, float]]):
        self.tree, self.weights = tree, weights

    def _vote(self, node: str, x: np.ndarray) -> tuple[str, float]:
        """The name with most wins, then the largest sum of margins; and its weakest margin as a score."""
        names = self.tree.nodes[node]
        wins, margin, weakest = [0] * len(names), [0.0] * len(names), [1.0] * len(names)
        for a in range(len(names)):
            for b in range(a + 1, len(names)):
                if (node, a, b) not in self.weights:
                    continue  # a machine without rows says nothing
                w, bias = self.weights[node, a, b]
                m = float(x @ w) + bias
                for k, value in ((a, m), (b, -m)):
                    wins[k] += value > 0
                    margin[k] += value
                    weakest[k] = min(weakest[k], 1 / (1 + math.exp(-max(-30.0, min(30.0, 3 * value)))))
        best = max(range(len(names)), key=lambda k: (wins[k], margin[k], names[k]))
        return names[best], weakest[best]

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text)
        if x is None or self.tree is None:
            return UNDETERMINED, 0.0
        name, score = self.tree.root, 1.0
        while name in self.tree.nodes:
            name, sure = self._vote(name, x)
            score = min(score, sure)
        return self.tree.under[name][0], score


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from text and lang of rows whose remainder is not 0.

    About ``sample_rows`` rows of each language are turned into features, which
    bounds each training task; languages are as many as there are, a row of
    counts and some 80 KB of weights each.
    """
    spark = docs.sparkSession
    labelled = docs.select("doc_id", "text", "lang").where((remainder() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return Model(None, {})
    ship_package(spark)
    grain = 1 << 40
    chance = lambda salt: F.pmod(F.xxhash64("doc_id", salt), F.lit(grain))
    # A row per language, and per language and level.
    rates = spark.createDataFrame([(lang, min(grain, grain * sample_rows // n)) for lang, n in counts.items()], "lang string, rate long")
    sample = labelled.join(F.broadcast(rates), "lang").where(chance(F.lit("sample")) < F.col("rate"))
    vectors = stored_copy(each_text(sample, _vector, ["doc_id", "lang", "text"], "doc_id long, lang string, at binary, x binary").where("x is not null"), "vectors")
    tree = Tree(list(counts))
    if any("/" in node for node in tree.nodes):
        found = vectors.groupBy("lang").applyInPandas(_mean, "lang string, mean binary").collect()
        tree = Tree(list(counts), {r["lang"]: np.frombuffer(r["mean"], np.float32) for r in found})
    uses = [(lang, node, place, int(grain * share)) for lang, node, place, share in tree.uses(counts, sample_rows)]
    if not uses:
        return Model(tree, {})
    uses = spark.createDataFrame(uses, "lang string, node string, place int, share long")
    dealt = vectors.join(F.broadcast(uses), "lang").where(chance(F.col("node")) < F.col("share")).select("doc_id", "at", "x", "node", "place")
    trained = dealt.groupBy("node").applyInPandas(_train_node, "node string, a int, b int, w binary, bias double").collect()
    return Model(tree, {(r["node"], r["a"], r["b"]): (np.frombuffer(r["w"], np.float32), r["bias"]) for r in trained})


def _vector(doc_id, lang, text):
    """The features that are not 0: their places, and the features."""
    x = features(text)
    if x is None:
        return doc_id, lang, None, None
    at = np.flatnonzero(x)
    return doc_id, lang, at.astype("<u2").tobytes(), x[at].tobytes()


def _dense(rows: pd.DataFrame) -> np.ndarray:
    out = np.zeros((len(rows), FEATURES), np.float32)
    for k, (at, x) in enumerate(zip(rows["at"], rows["x"])):
        out[k, np.frombuffer(at, "<u2")] = np.frombuffer(x, np.float32)
    return out


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "mean": [_dense(rows.sort_values(["doc_id", "x"])).mean(0, dtype=np.float64).astype(np.float32).tobytes()]})


def _train_node(rows: pd.DataFrame) -> pd.DataFrame:
    """One machine for each two names of a node, one after the other."""
    rows, out = rows.sort_values(["doc_id", "at", "x"], kind="stable"), []
    places = sorted(rows["place"].unique().tolist())
    for i, a in enumerate(places):
        for b in places[i + 1 :]:
            some = rows[rows["place"].isin((a, b))]
            w, bias = train_pair(_dense(some), np.where(some["place"] == a, 1, -1))
            out.append((rows["node"].iloc[0], a, b, w.tobytes(), bias))
    return pd.DataFrame(out, columns=["node", "a", "b", "w", "bias"])


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang, any others).

    ``und`` with score 0 for NULL texts, texts without a letter, and if
    nothing could be learned. Rows without doc_id are neither learned from nor
    held out by remainder; they count as held out. Repeated rows give repeated
    results.
    """
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES floats a pair

    def row(doc_id, held_out, text):
        lang, score = shared.value.predict(text)
        return doc_id, held_out, lang, score

    asked = docs.select("doc_id", F.coalesce(remainder() == 0, F.lit(True)).alias("held_out"), "text")
    return each_text(asked, row, ["doc_id", "held_out", "text"], "doc_id long, held_out boolean, lang_pred string, score double")
