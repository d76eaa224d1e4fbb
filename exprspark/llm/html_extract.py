"""HTML main-text extraction by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks; each has features of its ancestors (regions that tags, classes, ids and roles name or hint at), of
its own tag, of its text (size, links, marks, share of the page) and of its neighbours' texts. The model has a weight for each feature and label and for each pair of
neighbouring labels, fitted by gradient steps on the exact conditional likelihood of labelled pages, and is decoded
by Viterbi. Blocks labelled main are joined by line breaks.

Defined results: a null or empty page has the empty text; markup that never ends runs to the end of the page; a line break
element is white space; rows are judged one by one, so ties and repeats do not matter; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.llm.html_blocks import BIT, SLOTS, Block, blocks
from exprspark.llm.html_training import labelled_pages

PAGES, EPOCHS, RATE, DECAY = 500, 120, 0.1, 2e-4
TAGS = ("p", "h1", "h2", "h3", "h4", "li", "td", "th", "div", "section", "article", "main", "body", "pre", "blockquote", "button", "footer", "header", "nav", "ul", "figcaption", "dd", "dt")
FIXED = ["bias", *[f"in {r}" for r in BIT], *[f"hint {r}" for r in BIT], *[f"near {r}" for r in BIT], *[f"near hint {r}" for r in BIT], "near none", *[f"tag {t}" for t in TAGS], "tag other",
         *[f"size {i}" for i in range(6)], *[f"links {i}" for i in range(4)], "sentence", "inner stop", "commas", "copyright", "first", "last", "prose", "prose near", "prose around", "large share", "no prose on page", "top group", "prose in top group", "only group",
         *[f"main and {r}" for r in BIT if r != "main"], *[f"prose and {r}" for r in BIT], *[f"prose and hint {r}" for r in BIT], "long and none", *[f"word {i}" for i in range(SLOTS)]]
AT = {name: i for i, name in enumerate(FIXED)}
_SIZES = (15, 40, 100, 250, 600)
#: marks and phrases of ownership (fixed values)
_OWNED = re.compile(r"©|\(c\)|copyright|all rights reserved|tous droits réservés|todos los derechos reservados|alle rechte vorbehalten", re.I)


@lru_cache(maxsize=1 << 14)
def _place(tag: str, regions: int, hints: int, nearest: int, nearest_hints: int, words: tuple[int, ...], prose: bool) -> tuple[int, ...]:
    out = [AT["bias"], AT.get(f"tag {tag}", AT["tag other"])]
    for r, bit in BIT.items():
        if regions & bit:
            out.append(AT[f"in {r}"])
            if prose:
                out.append(AT[f"prose and {r}"])
            if r != "main" and regions & BIT["main"]:
                out.append(AT[f"main and {r}"])
        elif hints & bit:
            out.append(AT[f"hint {r}"])
            if prose:
                out.append(AT[f"prose and hint {r}"])
        if nearest & bit:
            out.append(AT[f"near {r}"])
        elif nearest_hints & bit:
            out.append(AT[f"near hint {r}"])
    if not nearest and not nearest_hints:
        out.append(AT["near none"])
    out += [AT["word 0"] + i for i in words]
    return tuple(out)


def block_features(page: list[Block]) -> list[list[int]]:
    """Numbers of the features that hold for each block."""
    total = sum(len(b.text) for b in page)
    # running text: some length, few links, and an end or an inner stop of a sentence
    prose = [len(b.text) > 60 and b.linked < 0.4 * len(b.text) and (b.text[-1] in ".!?…:" or ". " in b.text) for b in page]
    # blocks whose ancestors say the same are a group; the one with most running text is likely the article's
    weight: dict[tuple, int] = {}
    groups = [(b.regions, b.hints, b.nearest, b.nearest_hints) for b in page]
    for group, b, is_prose in zip(groups, page, prose):
        weight[group] = weight.get(group, 0) + len(b.text) * is_prose
    top = max(weight, key=weight.__getitem__, default=None)
    out = []
    for i, b in enumerate(page):
        n = len(b.text)
        size = sum(n > s for s in _SIZES)
        share = min(b.linked / n, 1)
        x = [*_place(b.tag, b.regions, b.hints, b.nearest, b.nearest_hints, b.words, prose[i]), AT["size 0"] + size, AT["links 0"] + (0 if not share else 1 if share < 0.3 else 2 if share < 0.8 else 3)]
        if b.text[-1] in ".!?…":
            x.append(AT["sentence"])
        if ". " in b.text:
            x.append(AT["inner stop"])
        if b.text.count(",") > 1:
            x.append(AT["commas"])
        if _OWNED.search(b.text):
            x.append(AT["copyright"])
        if prose[i]:
            x.append(AT["prose"])
        near = prose[max(0, i - 2):i] + prose[i + 1:i + 3]
        if any(near):
            x.append(AT["prose near"])
        if any(prose[max(0, i - 3):i]) and any(prose[i + 1:i + 4]):
            x.append(AT["prose around"])
        if n > 0.2 * total and len(page) > 3:
            x.append(AT["large share"])
        if not any(prose):
            x.append(AT["no prose on page"])
        elif groups[i] == top:
            x.append(AT["top group"])
            if prose[i]:
                x.append(AT["prose in top group"])
            if weight[top] > 0.8 * sum(weight.values()):
                x.append(AT["only group"])
        if not b.nearest and not b.nearest_hints and size >= 2:
            x.append(AT["long and none"])
        out.append(x)
    if out:
        out[0].append(AT["first"])
        out[-1].append(AT["last"])
    return out


class Field:
    """Weights of a two-label chain: ``emit`` features x labels, ``move`` labels x labels."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    def decode(self, features: list[list[int]]) -> list[int]:
        """The best labels by Viterbi."""
        if not features:
            return []
        scores = [(sum(self._no[i] for i in x), sum(self._yes[i] for i in x)) for x in features]
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = scores[0]
        back = []
        for no, yes in scores[1:]:
            back.append((int(b + m10 > a + m00), int(b + m11 > a + m01)))
            a, b = max(a + m00, b + m10) + no, max(a + m01, b + m11) + yes
        label, out = int(b > a), []
        for step in reversed(back):
            out.append(label)
            label = step[label]
        out.append(label)
        return out[::-1]

    @property
    def _no(self) -> list[float]:
        return self._columns()[0]

    @property
    def _yes(self) -> list[float]:
        return self._columns()[1]

    def _columns(self) -> tuple[list[float], list[float]]:
        if not hasattr(self, "_lists"):
            self._lists = self.emit[:, 0].tolist(), self.emit[:, 1].tolist()
        return self._lists


def fit(pages: list[tuple[list[list[int]], list[int]]]) -> Field:
    """Adam steps on the mean conditional log likelihood of all pages, forward and backward over padded pages."""
    pages = [(x, y) for x, y in pages if x]
    n, long = len(pages), max(len(y) for _, y in pages)
    x, y, mask = np.zeros((n, long, len(FIXED))), np.zeros((n, long), int), np.zeros((n, long), bool)
    for i, (fs, labels) in enumerate(pages):
        mask[i, :len(labels)], y[i, :len(labels)] = True, labels
        for t, f in enumerate(fs):
            x[i, t, f] = 1
    flat, gold = x[mask], np.eye(2)[y[mask]]
    pairs = mask[:, 1:]
    gold_move = np.zeros((2, 2))
    np.add.at(gold_move, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    gold_emit = flat.T @ gold
    emit, move = np.zeros((len(FIXED), 2)), np.zeros((2, 2))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (emit, move)]
    for step in range(1, EPOCHS + 1):
        score = np.zeros((n, long, 2))
        score[mask] = flat @ emit
        alpha, beta = np.zeros((n, long, 2)), np.zeros((n, long, 2))
        alpha[:, 0] = score[:, 0]
        for t in range(1, long):
            alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + score[:, t]
        for t in range(long - 2, -1, -1):
            inner = np.logaddexp.reduce(move + (score[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None], inner, 0.0)
        both = alpha + beta
        total = np.logaddexp.reduce(both, axis=2)
        state_p = np.exp(both - total[:, :, None])[mask]
        joint = alpha[:, :-1, :, None] + move + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, 1:, None, None]
        grads = ((gold_emit - flat.T @ state_p) / n - DECAY * emit, (gold_move - np.exp(joint[pairs]).sum(axis=0)) / n - DECAY * move)
        for p, g, (m, v) in zip((emit, move), grads, state):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field(emit, move)


def train(pages: list[tuple[str, list[int]]]) -> Field:
    """Fits on labelled pages: html and one label per block."""
    cut = [(blocks(page), labels) for page, labels in pages]
    if any(len(b) != len(y) for b, y in cut):
        raise ValueError("a labelled page needs one label per block")
    return fit([(block_features(b), y) for b, y in cut])


def main_text(page: str | None, field: Field) -> str:
    cut = blocks(page)
    return "\n".join(b.text for b, y in zip(cut, field.decode(block_features(cut))) if y)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row. Without ``field`` a model is fitted on the labelled pages of this package."""
    shared = pages.sparkSession.sparkContext.broadcast(field or train(labelled_pages(PAGES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts = [main_text(x.as_py(), shared.value) for x in part.column("html")]
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                      ["page_id", "url", "text", "n_chars"])

    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return keyed.mapInArrow(run, "page_id long, url string, text string, n_chars long")
