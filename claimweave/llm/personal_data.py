"""Personal data by fixed patterns, and further spans picked by boosted trees.

Base spans (e-mail, ip, card, phone) follow fixed rules. Generators of high recall then propose
overlapping spans of the same kinds: dotted quads in longer runs, card numbers among neighbouring
digit groups, telephone numbers without a plus, spelled-out addresses. Gradient-boosted trees over
format and context features pick among the proposals that touch no base span.

Positives for training are base spans written, in their own context and alone, in ways that the base
patterns miss. Negatives are proposals that cut such a span wrongly, spoiled spans, and proposals that break
the rule of their kind. Other proposals are unlabelled: those less likely than almost all positives
hidden among them join the negatives, the rest take no part. Probabilities are calibrated on
held-back documents, and one threshold for all kinds is the lowest that is precise there.
Picked proposals are added; base spans always stay.

All examples of all texts train the trees. Equal examples are one row with a count; features fall into
bins cut at quantiles of all their values, and a level of a tree is grown from sums of gradients per node,
feature and bin. Sums are of whole numbers, so they are the same however the rows are dealt: by Spark, task by
task, or in the driver once the distinct rows are few.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.tables import each_text, lean, materialize, read_table, unused

# Kinds in order, their patterns and limits.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators beyond the base patterns.
_QUAD = re.compile(r"(?=(?<![0-9])([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})(?![0-9]))")
_GROUPS = re.compile(r"[0-9]+(?:[\x20./-][0-9]+)*")
_DIGITS = re.compile(r"[0-9]+")
_LOOSE_PHONE = re.compile(r"(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]?\(?[0-9]{2,4}\)?){2,4}")
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:\(at\)|\[at\]|\sat\s|@)\s?[A-Za-z0-9-]{1,63}"
    r"(?:\s?(?:\(dot\)|\[dot\]|\sdot\s|\.)\s?[A-Za-z0-9-]{2,63}){1,4}"
)

_DOT = re.compile(r"\s?(?:\(dot\)|\[dot\]|\sdot\s|\.)\s?(?=[A-Za-z0-9-])")
_AT = re.compile(r"\(at\)|\[at\]|\sat\s|@")
_MORE = re.compile(r"[\x20./-]?[0-9]")

# Training: every how manieth positive is hidden among the unlabelled ones and the share of these that
# may fall below the cut, the precision that the threshold must have, and the least probability of a
# picked span.
SPIES = 7
LOST = 0.05
PRECISE = 0.98
LIKELY = 0.9
# Bins of a feature, parts of one in sums of gradients, steps of a score in counts of scores and their
# bound, and the most distinct rows that are summed in the driver.
BINS = 64
PARTS = 1 << 20
STEPS, BOUND = 1000, 30
FEW_ROWS = 1 << 17


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    digits = _only_digits(text)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def _emails(text: str):
    """Leftmost non-overlapping addresses, found from their signs, in time linear in the text."""
    last, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, sign + 1) if start < sign else None
        last = found.end() if found else last
        if found:
            yield start, last
        sign = text.find("@", max(sign + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed; offsets are code points, ends exclusive."""
    out = [("email", a, z) for a, z in _emails(text)]
    if _DIGITS.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            out += [(kind, *m.span()) for m in pattern.finditer(text) if _valid(kind, m.group())]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def proposals(text: str, signs: bool = True) -> list[tuple[str, int, int]]:
    """Spans of high recall, overlapping ones included. ``signs``: addresses only if a sign of one is in the text."""
    out = set()
    if "@" in text or "at" in text:
        for m in _SPELLED.finditer(text) if not signs or re.search(r"@|\(at\)|\[at\]|\bdot\b", text) else ():
            # Whole, and up to every label after the first dot of the domain.
            dots = [d.start() for d in _DOT.finditer(text, _AT.search(text, m.start()).end(), m.end())]
            out |= {("email", m.start(), z) for z in [*dots[1:], m.end()]}
    if _DIGITS.search(text):
        out |= {("ip", m.start(1), m.end(1)) for m in _QUAD.finditer(text)}
        out |= {("phone", *m.span()) for m in _LOOSE_PHONE.finditer(text) if 7 <= len(_only_digits(m.group())) <= 15}
        for run in _GROUPS.finditer(text):
            groups = [(run.start() + m.start(), run.start() + m.end()) for m in _DIGITS.finditer(run.group())]
            for i, (a, _) in enumerate(groups):
                count = 0
                for b, z in groups[i : i + 19]:
                    count += z - b
                    if count > 19:
                        break
                    if count >= 12:
                        out.add(("card", a, z))
    return sorted(out, key=lambda s: (s[1], s[2], KINDS.index(s[0])))


_SIGNS = re.compile(r"[^0-9A-Za-z]")
_CLUES = {
    "email": re.compile(r"mail|contact|write|kontakt|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|from", re.I),
    "card": re.compile(r"card|visa|credit|account|karte|tarjeta|carte", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|ruf|appel", re.I),
}
FEATURES = 30


def span_features(text: str, kind: str, a: int, z: int) -> list[float]:
    """Format of a span, and of the text around it."""
    span, before, after = text[a:z], text[max(0, a - 24) : a], text[z : z + 12]
    groups = _DIGITS.findall(span)
    digits, signs = "".join(groups), _SIGNS.findall(span)
    parts = [int(g[:6]) for g in groups] or [0]
    left, right = before[-1:], after[:1]
    return [
        *(float(kind == k) for k in KINDS),
        z - a, len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(set(signs)), len(signs), float("+" in span[:1]), float("(" in span), float("@" in span),
        max(parts), float(bool(digits) and luhn(digits)), span.count("."), float(signs.count(" ")),
        float(left.isalnum() or left in tuple(".-+@_/") and left != ""), float(right.isalnum() or right in tuple("-@_/") and right != ""),
        float(bool(_CLUES[kind].search(before))), float(before.rstrip()[-1:] in tuple(":=#") and before.strip() != ""),
        float(_valid(kind, span)), float(bool(_MORE.match(after))), float(bool(_MORE.match(before[::-1]))),
        float("(at)" in span or "[at]" in span), float(" at " in span), float("dot" in span),
        float(bool(re.search(r"\.\s", span))), float(bool(_DOT.match(after))),
    ]


@dataclass
class Trees:
    """Boosted trees on one feature list; splits are (feature, value or bin, left, right), leaves numbers."""

    base: float = 0.0
    trees: list = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += _leaves(tree, x)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -30, 30)))


def _leaves(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    feature, value, low, high = tree
    left = x[:, feature] <= value
    out = np.empty(len(x))
    out[left], out[~left] = _leaves(low, x[left]), _leaves(high, x[~left])
    return out


def _edges(values: np.ndarray) -> np.ndarray:
    """The largest whole number that begins with the same three digits and has as many."""
    scale = np.ones_like(values)
    for power in range(3, 10):
        scale[values >= 10**power] = 10 ** (power - 2)
    return (values // scale + 1) * scale - 1


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Number of cuts below each value."""
    return np.stack([np.searchsorted(c, _edges(x[:, f])) for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _by_value(tree, cuts: list[np.ndarray]):
    """A tree on bins as one on values."""
    if isinstance(tree, float):
        return tree
    f, at, low, high = tree
    return (f, float(cuts[f][at]), _by_value(low, cuts), _by_value(high, cuts))


@dataclass
class Examples:
    """Distinct binned examples and their counts; how often they occur is summed in the driver or by Spark.

    A block is (bins, mark, whether held back, whether a hidden positive, count). ``blocks`` holds all rows
    of a small table, otherwise every sum is a pass over ``table``.
    """

    table: DataFrame
    blocks: list | None = None

    def total(self, measure, size: int) -> np.ndarray:
        """Sum of the whole numbers ``measure`` makes of each block, ``size`` of them."""
        if self.blocks is not None:
            return sum((measure(*b) for b in self.blocks), np.zeros(size, np.int64))

        def add(batches):
            out = np.zeros(size, np.int64)
            for batch in batches:
                out += measure(*_block(batch))
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["at", "n"])

        sums = self.table.mapInArrow(lean(add), "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros(size, np.int64)
        out[sums["at"].to_numpy()] = sums["n"].to_numpy()
        return out


def _block(batch):
    bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, FEATURES)
    mark, back, spy, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
    return bins, mark, back, spy, n


def _add(cells: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Sum of whole numbers per cell; exact below 2^53."""
    return np.bincount(cells, n.astype(float), size).astype(np.int64)


def _steps(raw: np.ndarray) -> np.ndarray:
    """Scores as steps from the least one."""
    return np.rint((np.clip(raw, -BOUND, BOUND) + BOUND) * STEPS).astype(np.int64)


SCORES = 2 * BOUND * STEPS + 1


def _node(tree, bins: np.ndarray) -> np.ndarray:
    """Number of the open leaf, one that is still to be split, each row is in; -1 in closed ones."""
    if not isinstance(tree, tuple):
        return np.full(len(bins), tree if isinstance(tree, int) else -1)
    f, at, low, high = tree
    left = bins[:, f] <= at
    out = np.empty(len(bins), np.int64)
    out[left], out[~left] = _node(low, bins[left]), _node(high, bins[~left])
    return out


def _put(tree, leaves: dict):
    """A tree with its open leaves replaced."""
    if isinstance(tree, tuple):
        return (*tree[:2], _put(tree[2], leaves), _put(tree[3], leaves))
    return leaves[tree] if isinstance(tree, int) else tree


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray):
    """The best (feature, bin) of a node by its sums per feature and bin, None if none gains."""
    if n[0].sum() < 8:
        return None
    gl, hl, nl = (np.cumsum(a, axis=1) for a in (g, h, n))
    whole_g, whole_h, whole_n = gl[:, -1:], hl[:, -1:], nl[:, -1:]
    gain = gl**2 / (hl + 1) + (whole_g - gl) ** 2 / (whole_h - hl + 1) - whole_g**2 / (whole_h + 1)
    gain[(nl == 0) | (nl == whole_n)] = 0
    best = int(np.argmax(gain))
    return divmod(best, BINS) if gain.flat[best] > 1e-6 else None


def boost(examples: Examples, target, base: float, rounds: int = 30, depth: int = 3, rate: float = 0.3) -> Trees:
    """Trees on bins, one pass over the examples per level. ``target`` makes (y, whether used) of a block."""
    model = Trees(base=base)
    for _ in range(rounds):
        tree, leaves = 0, 1  # open leaves are whole numbers
        for level in range(depth):
            shape = (leaves, FEATURES, BINS)

            def sums(bins, mark, back, spy, n, tree=tree, cells=leaves * FEATURES * BINS):
                y, used = target(bins, mark, back, spy)
                node = _node(tree, bins)
                used = used & (node >= 0)
                bins, y, n, node = bins[used], y[used], n[used], node[used]
                p = 1 / (1 + np.exp(-model.raw(bins)))
                at = ((node[:, None] * FEATURES + np.arange(FEATURES)) * BINS + bins).ravel()
                parts = [np.rint((p - y) * PARTS) * n, np.rint(p * (1 - p) * PARTS) * n, n]
                return np.concatenate([_add(at, np.repeat(w, FEATURES), cells) for w in parts])

            found = examples.total(sums, 3 * leaves * FEATURES * BINS).reshape(3, *shape)
            g, h, n = found[0] / PARTS, found[1] / PARTS, found[2]
            grown, leaves = {}, 0
            for i in range(shape[0]):
                whole = float(-rate * g[i, 0].sum() / (h[i, 0].sum() + 1))
                best = _split(g[i], h[i], n[i])
                if best is None:
                    grown[i] = whole
                elif level + 1 < depth:
                    grown[i] = (*best, leaves, leaves + 1)
                    leaves += 2
                else:
                    f, at = best
                    sides = [(g[i, f, s].sum(), h[i, f, s].sum()) for s in (slice(0, at + 1), slice(at + 1, None))]
                    grown[i] = (f, at, *(float(-rate * gs / (hs + 1)) for gs, hs in sides))
            tree = _put(tree, grown)
            if not leaves:
                break
        model.trees.append(tree)
    return model


def calibrate(model: Trees, raw: np.ndarray, good: np.ndarray, bad: np.ndarray) -> None:
    """Fits probability = sigmoid(slope * raw + shift) by Newton steps, targets softened by counts.

    ``good`` and ``bad`` count the positives and negatives of each score.
    """
    a, b, n = 1.0, 0.0, good + bad
    positive, negative = good.sum(), bad.sum()
    target = good * ((positive + 1) / (positive + 2)) + bad * (1 / (negative + 2))
    for _ in range(100):  # held near slope 1 and shift 0, as separable examples have no best slope
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        d, w = n * p - target, n * p * (1 - p)
        step = np.linalg.solve(
            np.array([[(w * raw * raw).sum() + 1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1]]),
            np.array([(d * raw).sum() + a - 1, d.sum() + b]),
        )
        a, b = a - float(np.clip(step[0], -0.2, 0.2)), b - float(np.clip(step[1], -0.2, 0.2))
    model.slope, model.shift = max(a, 1e-3), b


@dataclass
class Picker:
    """Trees and a threshold per kind; without trees nothing is added."""

    trees: Trees | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Picked proposals that touch no base span, the best of overlapping ones."""
        if self.trees is None:
            return []
        taken: list[tuple[int, int]] = []  # disjoint, in order
        for _, a, z in sorted(base, key=lambda s: s[1:]):
            if taken and a < taken[-1][1]:
                taken[-1] = (taken[-1][0], max(z, taken[-1][1]))
            else:
                taken.append((a, z))

        def free(a: int, z: int) -> bool:
            i = bisect_left(taken, (z, 0))
            return i == 0 or taken[i - 1][1] <= a

        new = [s for s in proposals(text) if free(*s[1:])]
        if not new:
            return []
        p = self.trees.probability(np.array([span_features(text, *s) for s in new]))
        out: list[tuple[str, int, int]] = []
        for i in sorted(range(len(new)), key=lambda i: (-p[i], new[i][1], new[i][2])):
            kind, a, z = new[i]
            if p[i] >= self.thresholds[kind] and free(a, z):
                insort(taken, (a, z))
                out.append(new[i])
        return out


def disguises(kind: str, span: str, draw: int) -> list[tuple[str, str, str]]:
    """A base span as the base patterns miss it: (text glued before, the span, text glued after)."""
    if kind == "email":
        local, domain = span.split("@")
        signs = [(" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "(dot)"), (" @ ", "."),
                 (" (at) ", "."), ("[at]", "."), ("@", " dot "), ("@", " (dot) ")]
        short, out = ".".join(domain.split(".")[-2:]), []
        for i in range(4):
            at, dot = signs[(draw + 2 * i) % 9]
            name = local if i < 2 else re.sub("[^A-Za-z]", "", local) or local
            out.append(("", name + at + (short if i % 2 else domain).replace(".", dot), ""))
        return out
    if kind == "ip":
        return [(f"{256 + draw % 700}.", span, ""), (f"{1000 + draw % 9000}.", span, ""), (f"{256 + draw // 7 % 700}.{draw % 256}.", span, "")]
    digits = _only_digits(span)
    if kind == "card":
        glued, sign = str(draw % 10 ** (1 + draw // 7 % 4)), " -"[draw // 11 % 2]
        fours = ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
        return [(glued + sign, span, ""), ("", span, sign + glued), (glued + " ", span, " " + glued), ("", fours, "")]
    rest = re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", span)
    plain = re.sub(r"[^0-9]+", " -."[draw % 3], rest).strip(" -.")
    out = [span[1:], "00" + span[1:], rest, plain]
    return [("", x, "") for x in out if 9 <= len(_only_digits(x)) <= 15]


def spoiled(kind: str, span: str, draw: int) -> list[tuple[str, str, str]]:
    """Texts of the same looks that are no span of the kind: (glued before, the text, glued after)."""
    if kind == "email":
        local, domain = span.split("@")
        words = [re.sub("[^a-z]", "", x.lower()) or "it" for x in (local, *domain.split("."))]
        return [("", f"{words[0]} at {words[1]}. {words[-1].capitalize()}", ""), ("", f"{words[-1]} at {words[0]}. {words[1].capitalize()}", "")]
    if kind == "ip":
        first, last = span.rsplit(".", 1)
        return [("", f"{first}.{256 + int(last.lstrip('0') or 0) % 256}", "")]
    if kind == "card":
        return [("", span[:-1] + str((int(span[-1]) + 1 + draw % 9) % 10), "")]
    sign = "-./"[draw % 3]
    day = sign.join((str(1900 + draw % 150), f"{1 + draw // 7 % 12:02d}", f"{1 + draw // 11 % 28:02d}"))
    return [("abcdef"[draw % 6], _only_digits(span), "fedcba"[draw % 6]), ("", f"{day} {draw // 13 % 24:02d}", "")]


# What an example is.
NEGATIVE, POSITIVE, UNLABELLED = 0, 1, 2


def marked(text: str) -> list[tuple[list[float], int]]:
    """(features, mark) of the examples of a text."""
    base, out = base_spans(text), []

    def touches(a: int, z: int, spans) -> bool:
        return any(a < d and c < z for _, c, d in spans)

    # Neighbouring base spans by start keep the search short.
    ends, starts = [], [a for _, a, _ in base]
    for _, _, z in base:
        ends.append(max(z, ends[-1]) if ends else z)
    for kind, a, z in proposals(text):
        i = bisect_left(starts, z)
        if i == 0 or ends[i - 1] <= a:
            sure = not _valid(kind, text[a:z])
            out.append((span_features(text, kind, a, z), NEGATIVE if sure else UNLABELLED))
    for kind, a, z in base:
        before, after = text[max(0, a - 40) : a], text[z : z + 40]
        draw = zlib.crc32((before + text[a:z] + after).encode("utf-8", "replace"))
        forms = [(x, True) for x in disguises(kind, text[a:z], draw)] + [(x, False) for x in spoiled(kind, text[a:z], draw)]
        # In their own context, and alone.
        for ((left, span, right), good), (head, foot) in product(forms, [(before, after), (" ", " ")]):
            new = head + left + span + right + foot
            at = len(head) + len(left)
            to = at + len(span)
            found = base_spans(new)
            if good and touches(at, to, found):
                continue
            for other, c, d in proposals(new, signs=False):
                if c < to and at < d and not touches(c, d, found):
                    same = good and (other, c, d) == (kind, at, to)
                    out.append((span_features(new, other, c, d), POSITIVE if same else NEGATIVE))
    return out


def examples(documents: DataFrame) -> DataFrame:
    """(features, mark, back, spy, n): the distinct examples of all texts and how often they occur.

    The examples of a fifth of the texts are held back for calibration; a seventh of the positives are hidden
    among the unlabelled ones.
    """
    names = ["features", "mark", "back", "spy", "n"]

    def collect(batches):
        for batch in batches:
            found = Counter()
            for fold, text in zip(batch.column(0).to_pylist(), each_text(batch.column(1))):
                draw = zlib.crc32((text or "").encode("utf-8", "replace"))
                for features, mark in marked(text or ""):
                    draw += mark == POSITIVE
                    found[(*map(int, features), mark, fold == 0, mark == POSITIVE and draw % SPIES == 0)] += 1
            rows = list(found)
            columns = [[r[:FEATURES] for r in rows], *([r[FEATURES + i] for r in rows] for i in range(3)), list(found.values())]
            kinds = [pa.list_(pa.int32()), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    dealt = documents.select(F.pmod(F.xxhash64("text"), F.lit(5)).cast("int").alias("fold"), "text")
    found = dealt.mapInArrow(lean(collect), "features array<int>, mark int, back boolean, spy boolean, n bigint")
    return found.groupBy(*names[:4]).agg(F.sum("n").alias("n"))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, FEATURES)


def feature_cuts(found: DataFrame) -> list[np.ndarray]:
    """Cuts of each feature at quantiles of all its values, or at every value of one with few.

    Values count by their first three digits, so there are few whatever the number of examples.
    """

    def count(batches):
        for batch in batches:
            x, n = _edges(_matrix(batch.column(0))), batch.column(1).to_numpy()
            for f in range(FEATURES if len(x) else 0):
                value, at = np.unique(x[:, f], return_inverse=True)
                columns = [pa.array(np.full(len(value), f)), pa.array(value), pa.array(_add(at, n, len(value)))]
                yield pa.RecordBatch.from_arrays(columns, ["f", "value", "n"])

    rows = found.select("features", "n").mapInArrow(lean(count), "f bigint, value bigint, n bigint")
    counts = rows.groupBy("f", "value").agg(F.sum("n").alias("n")).toPandas()
    out = []
    for f in range(FEATURES):
        own = counts[counts.f == f].sort_values("value")
        value, upto = own.value.to_numpy(), np.cumsum(own.n.to_numpy())
        if len(value) > BINS:
            at = np.linspace(0, 1, BINS + 1) * (upto[-1] - 1)
            value = np.unique(np.r_[value[np.searchsorted(upto, at.astype(np.int64), side="right")], value[-1]])[-BINS:]
        out.append(value[:-1])
    return out


def binned(found: DataFrame, cuts: list[np.ndarray]) -> Examples:
    """The distinct examples by their bins."""

    def cut(batches):
        for batch in batches:
            bins = [row.tobytes() for row in _bins(_matrix(batch.column(0)), cuts)] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.binary()), *batch.columns[1:]], ["bins", "mark", "back", "spy", "n"])

    rows = found.mapInArrow(lean(cut), "bins binary, mark int, back boolean, spy boolean, n bigint")
    table = materialize(rows.groupBy("bins", "mark", "back", "spy").agg(F.sum("n").alias("n")), "examples")
    few = table.count() <= FEW_ROWS
    return Examples(table, [_block(b) for b in table.toArrow().to_batches()] if few else None)


def _log_odds(positive: int, negative: int) -> float:
    mean = positive / max(positive + negative, 1)
    return float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))


def unlikely(found: Examples, whole: bool) -> tuple[Trees, int] | None:
    """Trees and the score, in steps, that almost all positives hidden among the unlabelled examples reach."""

    def target(bins, mark, back, spy):
        return ((mark == POSITIVE) & ~spy).astype(float), whole | ~back

    def sides(bins, mark, back, spy, n):
        return _add(np.where(spy, 2, mark == POSITIVE)[whole | ~back], n[whole | ~back], 3)

    negative, positive, hidden = map(int, found.total(sides, 3))
    if positive + hidden < 2 * SPIES or not hidden:
        return None
    trees = boost(found, target, _log_odds(positive, negative + hidden), rounds=15)

    def scores(bins, mark, back, spy, n):
        spy = spy & (whole | ~back)
        return _add(_steps(trees.raw(bins[spy])), n[spy], SCORES)

    spies = np.cumsum(found.total(scores, SCORES))
    return trees, int(np.searchsorted(spies, int((spies[-1] - 1) * LOST), side="right"))


def fit(documents: DataFrame) -> Picker:
    """Trains on all examples of all texts.

    A table with too few examples to hold some back is calibrated on those it is trained on; one
    without base spans has nothing to learn from and gets no further ones.
    """
    found = materialize(examples(documents), "marked")
    if found.isEmpty():
        return Picker()
    cuts = feature_cuts(found)
    return learn(binned(found, cuts), cuts)


def learn(found: Examples, cuts: list[np.ndarray]) -> Picker:
    """Trees, calibration and the threshold."""

    def count(bins, mark, back, spy, n):
        return _add(mark + 3 * back, n, 6)

    marks = found.total(count, 6).reshape(2, 3)
    whole = not (marks[:, [POSITIVE, NEGATIVE]] > 0).all()
    if not marks[:, POSITIVE].any():
        return Picker()
    cut = unlikely(found, whole) if marks[:, UNLABELLED].any() else None

    def target(bins, mark, back, spy, side=False):
        """Whether positive, and whether used on this side."""
        y, bad = mark == POSITIVE, mark == NEGATIVE
        rest = np.flatnonzero(mark == UNLABELLED)
        if cut is not None and len(rest):
            bad[rest] = _steps(cut[0].raw(bins[rest])) < cut[1]
        return y.astype(float), (y | bad) & (whole | (back == side))

    def used(bins, mark, back, spy, n):
        y, use = target(bins, mark, back, spy)
        return _add(y[use].astype(int), n[use], 2)

    negative, positive = map(int, found.total(used, 2))
    if not negative:
        return Picker()
    trees = boost(found, target, _log_odds(positive, negative))

    def scores(bins, mark, back, spy, n):
        y, use = target(bins, mark, back, spy, side=True)
        return _add(_steps(trees.raw(bins[use])) + SCORES * y[use].astype(int), n[use], 2 * SCORES)

    bad, good = found.total(scores, 2 * SCORES).reshape(2, SCORES)
    at = np.flatnonzero(bad + good)[::-1]  # most likely first
    raw, bad, good = at / STEPS - BOUND, bad[at], good[at]
    calibrate(trees, raw, good, bad)

    def probability(raw):
        return 1 / (1 + np.exp(-np.clip(trees.slope * raw + trees.shift, -30, 30)))

    p = probability(raw)
    precise = np.flatnonzero((np.cumsum(good) / np.cumsum(good + bad) >= PRECISE) & (p >= LIKELY))
    threshold = 2.0
    if len(precise):
        # The lowest one as precise: down to the next less likely score, or to LIKELY.
        last = precise[-1]
        lower = p[last + 1] if last + 1 < len(p) else 0.0
        threshold = LIKELY if lower < LIKELY else float(probability(raw[last] - 0.5 / STEPS))
    trees.trees = [_by_value(tree, cuts) for tree in trees.trees]
    return Picker(trees, dict.fromkeys(KINDS, threshold))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def find(documents: DataFrame, picker: Picker) -> DataFrame:
    """Counts and spans of every document: those of the query, and ``n_added``.

    Null text is empty. Spans are ``kind:start:end`` by start, then kind, then end.
    """
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]

    def scan(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), each_text(batch.column(1))):
                base = base_spans(text or "")
                added = picker.added(text or "", base)
                every = sorted([*base, *added], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((doc, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), len(added)))
            columns = list(zip(*rows)) or [[]] * 8
            kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = ", ".join(f"{n} {'string' if n in ('base_sha256', 'spans') else 'bigint'}" for n in names)
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(lean(scan), schema)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Spans replaced by their kind; of overlapping ones the union, named after the first."""
    out, at, end = [], 0, 0
    for kind, a, z in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[at:a], f"<{kind.upper()}>"]
            at = z
        end = max(end, z)
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, picker: Picker) -> DataFrame:
    """``documents`` with all spans in ``text`` replaced; ``n_chars`` follows. Null text stays null."""
    columns = documents.columns
    row, = unused([], "row")

    def clean(batches):
        for batch in batches:
            texts = []
            for text in each_text(batch.column(1)):
                base = base_spans(text or "")
                texts.append(text if text is None else redact_text(text, [*base, *picker.added(text, base)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "clean"])

    others = [c for c in columns if c != "text"]
    packed = documents.select(F.struct(*others).alias(row), "text")
    kind = packed.schema[row].dataType.simpleString()
    done = packed.mapInArrow(lean(clean), f"row {kind}, clean string").select("row.*", F.col("clean").alias("text"))
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return done.select(*columns)


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of all documents."""
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    return find(documents, fit(documents))
