"""Main text of HTML pages by a linear-chain conditional random field over their leaf blocks.

A page is a sequence of leaf blocks. Each has features from the tags, names and sections
around it and from its text; the field adds their weights for the labels "article" and "other"
and a weight for each pair of neighbouring labels. It is trained on labelled pages by
maximising the conditional likelihood (forward-backward, Adam), and a page's labels are the
best sequence, found by Viterbi. The model is small and fixed in size, and travels with the
task; pages are independent rows, so there is no shuffle.

Defined results: null and empty pages, and pages without article blocks, give an empty text.
Every row gives one row, whatever its id; repeated rows give equal texts. Of two labellings that
are equally probable the one with "other" earlier is taken. Pages of any length, and elements
nested to any depth, are read whole, one page at a time. An empty table gives an empty result.
Other input columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .html_blocks import Block, leaf_blocks
from .shared import quoted

# How a line of rights, of an article's filing, or of a menu begins or reads.
_RIGHTS = re.compile(r"©|\bcopyright\b|\ball rights reserved\b", re.IGNORECASE)
_FILED = re.compile(r"(?:tagged|tags|filed under|posted in|categor(?:y|ies)|topics|labels|share this|permalink)\b", re.IGNORECASE)
_SHORT = frozenset("home|about|about us|contact|contact us|next|prev|previous|read more|more|log in|login|sign up|sign in|share|menu|privacy|terms|search|subscribe|reply|archive|news|blog|help|faq".split("|"))
_NAMED_SECTIONS = frozenset("article aside footer form header main nav section".split())


def features(block: Block) -> list[str]:
    text, n = block.text, block.text.count(" ") + 1
    last = text[-1]
    link = 3 * block.linked // max(1, len(text)) if block.linked else -1
    rights, filed, short = bool(_RIGHTS.search(text)), bool(_FILED.match(text)), text.lower().rstrip(":") in _SHORT
    bare = not block.names and not _NAMED_SECTIONS.intersection(block.tags)
    return [
        "all",
        f"tag:{block.tag}",
        f"words:{min(6, n.bit_length())}",
        f"link:{link}",
        f"end:{'stop' if last in '.!?' else 'other'}",
        f"sections:{'/'.join(block.sections)}",
        *([f"rights:{min(4, n.bit_length())}"] if rights else []),
        *([f"filed:{min(4, n.bit_length())}:{link}"] if filed else []),
        *([f"short:{block.tag}", "short"] if short else []),
        *(["button"] if block.tag == "button" else []),
        # where neither names nor sections tell anything, the text alone must
        *([f"bare:{link}:{min(4, n.bit_length())}", f"bare:{block.tag}", f"bare:{rights}", f"bare:{short}"] if bare else []),
        *(f"in:{x}" for x in block.tags),
        *(f"name:{x}" for x in block.names),
        *(f"outer:{x}" for x in block.outer),
        *(["outer"] if block.outer else []),
    ]


class BlockField:
    """Weights of a two-label chain: per feature and label, and per pair of labels."""

    def __init__(self, names: dict[str, int]):
        self.names = names
        self.weights = np.zeros((len(names), 2))
        self.pairs = np.zeros((2, 2))

    def emissions(self, blocks: list[Block]) -> list[tuple[float, float]]:
        rows = self._rows
        out = []
        for b in blocks:
            x = y = 0.0
            for f in features(b):
                if f in rows:
                    u, v = rows[f]
                    x += u
                    y += v
            out.append((x, y))
        return out

    def finish(self) -> BlockField:
        self._rows = {f: tuple(self.weights[k].tolist()) for f, k in self.names.items()}
        self._pairs = self.pairs.tolist()
        self.known = frozenset(f.removeprefix("name:") for f in self.names if f.startswith("name:"))
        return self

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most probable labels, by Viterbi."""
        (a, b), (c, d) = self._pairs
        back, x, y = [], 0.0, 0.0
        for k, (u, v) in enumerate(self.emissions(blocks)):
            if k:
                from_x, from_y = (x + a >= y + c), (x + b >= y + d)
                back.append((0 if from_x else 1, 0 if from_y else 1))
                x, y = (x + a if from_x else y + c) + u, (x + b if from_y else y + d) + v
            else:
                x, y = u, v
        labels = [0 if x >= y else 1] if blocks else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


@lru_cache(maxsize=4)
def fitted_field(pages: int = 1600, seed: int = 5) -> BlockField:
    """The field fitted on pages made for it; fitted once in a session."""
    from .html_pages import labelled_pages

    return train_field(labelled_pages(pages, seed))


def _step(scores: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log sum over a of exp(scores[:, a] + pairs[a, b]) for each b."""
    return np.logaddexp(scores[:, :1] + pairs[0], scores[:, 1:] + pairs[1])


def train_field(pages: list[tuple[str, list[int]]], epochs: int = 120, rate: float = 0.1, decay: float = 5e-4, min_pages: int = 3) -> BlockField:
    """Fit a field on (html, labels of its leaf blocks)."""
    data = [([features(b) for b in leaf_blocks(html)], labels) for html, labels in pages]
    # longest first, so that the pages that still have a block at a step are the first ones
    data = sorted(((x, y) for x, y in data if x), key=lambda p: -len(p[0]))
    seen: dict[str, int] = {}
    for x, _ in data:
        for f in {f for b in x for f in b}:
            seen[f] = seen.get(f, 0) + 1
    field = BlockField({f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n >= min_pages))})
    n, steps = len(data), len(data[0][0])
    page, step, feature = (np.asarray(z) for z in zip(*((i, t, field.names[f]) for i, (x, _) in enumerate(data) for t, b in enumerate(x) for f in b if f in field.names), strict=True))
    lengths = np.asarray([len(x) for x, _ in data])
    there = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(steps)]  # pages with more than t blocks
    mask, gold = np.arange(steps) < lengths[:, None], np.zeros((n, steps), int)
    for i, (_, y) in enumerate(data):
        gold[i, : len(y)] = y
    total = mask.sum()
    slot = page * steps + step
    moments = [np.zeros_like(field.weights), np.zeros_like(field.weights), np.zeros_like(field.pairs), np.zeros_like(field.pairs)]
    one_hot = np.eye(2)[gold] * mask[..., None]
    gold_pairs = np.einsum("nta,ntb->ab", one_hot[:, :-1], one_hot[:, 1:])
    last = (np.arange(n), lengths - 1)
    for epoch in range(1, epochs + 1):
        e = np.stack([np.bincount(slot, field.weights[feature, c], n * steps).reshape(n, steps) for c in (0, 1)], -1)
        forward, backward = e.copy(), np.zeros_like(e)
        for t in range(1, steps):
            k = there[t]
            forward[:k, t] += _step(forward[:k, t - 1], field.pairs)
        norm = np.logaddexp(*forward[last].T)
        for t in range(steps - 2, -1, -1):
            k = there[t + 1]
            backward[:k, t] = _step(e[:k, t + 1] + backward[:k, t + 1], field.pairs.T)
        chance = np.exp(forward + backward - norm[:, None, None]) * mask[..., None]
        onward, both = e + backward, np.zeros((2, 2))
        for t in range(steps - 1):
            k = there[t + 1]
            both += np.exp(forward[:k, t, :, None] + field.pairs + onward[:k, t + 1, None, :] - norm[:k, None, None]).sum(axis=0)
        gap = (chance - one_hot).reshape(-1, 2) / total
        g = np.stack([np.bincount(feature, gap[slot, c], len(field.names)) for c in (0, 1)], -1) + decay * field.weights / 10
        gp = (both - gold_pairs) / total
        for x, grad, m, s in ((field.weights, g, moments[0], moments[1]), (field.pairs, gp, moments[2], moments[3])):
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            x -= rate * (m / (1 - 0.9**epoch)) / (np.sqrt(s / (1 - 0.999**epoch)) + 1e-8)
    return field.finish()


def main_text(html: str, field: BlockField) -> str:
    blocks = leaf_blocks(html, field.known)
    return "\n".join(b.text for b, label in zip(blocks, field.decode(blocks), strict=True) if label)


def _extract(batches, broadcast, names: list[str]):
    field = broadcast.value
    for batch in batches:
        texts, size, at = [], 0, 0
        for k, html in enumerate(batch.column(batch.num_columns - 1)):
            texts.append(main_text(html.as_py() or "", field))
            size += len(texts[-1])
            if size > 4 << 20 or k == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(texts)) for c in batch.columns[:-1]), pa.array(texts, pa.string())], names)
                at, texts, size = k + 1, [], 0


def extract_main_text(pages: DataFrame, field: BlockField, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns ``keep`` and ``text`` of every page."""
    schema = StructType([*(StructField(c, pages.schema[c].dataType) for c in keep), StructField("text", StringType())])
    work = partial(_extract, broadcast=pages.sparkSession.sparkContext.broadcast(field), names=[*keep, "text"])
    # plain names for the batches, as a name with a dot could not be passed on
    plain = (F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate([*keep, html_col]))
    return pages.select(*plain).mapInArrow(work, schema)
