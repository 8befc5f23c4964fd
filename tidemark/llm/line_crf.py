"""Quality rules: a linear-chain CRF marks the lines of a text, their share decides.

Every line with a word is a step of the chain and is described by a few binary features.  A
conditional random field over two labels, boilerplate and content, scores whole sequences;
Viterbi decoding finds the best one.  A document is retained when at least ``min_share`` of
its words stand in lines marked as content.

The field is trained on a bounded sample of labelled documents: at most ``sample`` of either
label, the first by a hash of their id, none with over ``max_lines`` lines; of an id with several
texts the first by a hash of the text.  Labels speak of
documents, not of lines, so training starts with every line of a document labelled like the
document, and then twice marks the lines of bad documents anew, keeping the marks wherever at
least half of the words stay boilerplate.  Where one of the two labels is missing, the stated
starting weights are used as they are.

A null or empty text has no words and no lines: its share is 0 and it is not retained.
Repeated rows are judged alike, an empty table gives an empty result, and columns other than
the two named ones are not read.  Texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import carried, drawn_texts, map_batches

#: Bounds of the training sample: documents per label, lines per document.
SAMPLE, MAX_LINES = 1000, 400
#: Share of the words that must stand in content lines.
MIN_SHARE = 0.5

SYMBOLS = "#*$%&|<>"
FEATURES = [
    "any",
    "mostly_upper",
    "some_symbols",
    "many_symbols",
    "exclaims",
    "short",
    "long",
    "long_words",
    "tiny_words",
    "sentence_end",
    "lower_start",
    "seen_before",
    "digits",
    "few_distinct",
    "bars",
    "address",
    "notice",
]
# Words of notices that sites put around their texts.
NOTICE_WORDS = frozenset(
    "copyright cookie cookies login subscribe newsletter privacy sitemap advertisement".split()
)


def line_features(line: str, words: list[str], seen: bool) -> int:
    """The features of one line as bits, in the order of ``FEATURES``."""
    n = len(words)
    letters = sum(map(len, words))
    symbols = sum(map(line.count, SYMBOLS))
    bits = (
        True,
        2 * sum(map(str.isupper, words)) > n,
        10 * symbols > n,
        2 * symbols > n,
        5 * line.count("!") > n,
        n <= 3,
        n >= 20,
        letters > 12 * n,
        2 * letters < 5 * n,
        line.rstrip()[-1:] in (".", "!", "?", "…"),
        line.lstrip()[:1].islower(),
        seen,
        5 * sum(map(line.count, "0123456789")) > letters,
        n >= 6 and 2 * len(set(words)) < n,
        10 * line.count("|") > n,
        "http" in line or "www." in line or "@" in line,
        not NOTICE_WORDS.isdisjoint(map(str.lower, words)),
    )
    return sum(1 << i for i, on in enumerate(bits) if on)


def line_sequence(text: str | None) -> tuple[list[int], list[int]]:
    """Features and numbers of words of every line that has a word."""
    masks, sizes, seen = [], [], set()
    for line in text.split("\n") if text else ():
        words = line.split()
        if words:
            masks.append(line_features(line, words, line in seen))
            sizes.append(len(words))
            seen.add(line)
    return masks, sizes


@dataclass
class LineCrf:
    """Weights: emission[label, feature], transition[from, to], start[label]; label 1 is
    content."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    @classmethod
    def untrained(cls) -> LineCrf:
        """Content, unless symbols, capitals, bars or repeats speak against it."""
        emission = np.zeros((2, len(FEATURES)))
        emission[1, 0] = 1.0
        against = ("mostly_upper", "many_symbols", "exclaims", "seen_before", "bars", "notice")
        for name in against:
            emission[0, FEATURES.index(name)] = 2.0
        return cls(emission, np.array([[0.5, -0.5], [-0.5, 0.5]]), np.zeros(2))

    def scores(self, masks: np.ndarray) -> np.ndarray:
        """Emission scores [..., label] of feature bits."""
        bits = (masks[..., None] >> np.arange(len(FEATURES))) & 1
        return bits @ self.emission.T

    def decode(self, masks: list[int]) -> list[int]:
        """Viterbi: the labels of the best sequence; content where two are equally good."""
        if not masks:
            return []
        steps = self.scores(np.array(masks)).tolist()
        (bb, bc), (cb, cc) = self.transition.tolist()
        b, c = (s + x for s, x in zip(self.start.tolist(), steps[0]))
        back = []
        for eb, ec in steps[1:]:
            b_from, c_from = int(c + cb >= b + bb), int(c + cc >= b + bc)
            back.append((b_from, c_from))
            b, c = (c + cb if b_from else b + bb) + eb, (c + cc if c_from else b + bc) + ec
        labels = [int(c >= b)]
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]

    def fit(self, masks: list[list[int]], labels: list[list[int]], rounds: int = 100) -> LineCrf:
        """Maximise the penalised conditional likelihood of the labels by Adam."""
        by_length: dict[int, list[int]] = {}
        for i, sequence in enumerate(masks):
            by_length.setdefault((len(sequence) - 1).bit_length(), []).append(i)
        grids, total = [], sum(map(len, masks))
        weights = [self.emission.copy(), self.transition.copy(), self.start.copy()]
        seen = [w * 0 for w in weights]
        for _, chosen in sorted(by_length.items()):  # so that padding at most doubles a grid
            longest = max(len(masks[i]) for i in chosen)
            inside = np.arange(longest) < np.array([len(masks[i]) for i in chosen])[:, None]
            grid, gold = np.zeros((2, *inside.shape), dtype=np.int64)
            grid[inside] = [x for i in chosen for x in masks[i]]
            gold[inside] = [x for i in chosen for x in labels[i]]
            bits = ((grid[..., None] >> np.arange(len(FEATURES))) & 1) * inside[..., None]
            one_hot = np.eye(2)[gold] * inside[..., None]
            seen[0] += np.einsum("itl,itf->lf", one_hot, bits)
            seen[1] += np.einsum("itl,itm->lm", one_hot[:, :-1], one_hot[:, 1:])
            seen[2] += one_hot[:, 0].sum(0)
            grids.append((bits.astype(float), inside))
        mean, square = [w * 0 for w in weights], [w * 0 for w in weights]
        for step in range(1, rounds + 1):
            expected = [sum(parts) for parts in zip(*(_expectations(*g, *weights) for g in grids))]
            for k, w in enumerate(weights):
                slope = (expected[k] - seen[k]) / total + 1e-4 * w
                mean[k] = 0.9 * mean[k] + 0.1 * slope
                square[k] = 0.999 * square[k] + 0.001 * slope**2
                rate = 0.1 / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                weights[k] = w - rate * mean[k] / (1 - 0.9**step)
        return LineCrf(*weights)


def _expectations(bits, inside, emission, transition, start):
    """Expected counts of features, transitions and first labels (forward, backward)."""
    scores = bits @ emission.T
    count, longest, _ = scores.shape
    forward = np.empty_like(scores)
    forward[:, 0] = start + scores[:, 0]
    for t in range(1, longest):
        step = np.logaddexp(
            forward[:, t - 1, :1] + transition[0], forward[:, t - 1, 1:] + transition[1]
        )
        forward[:, t] = np.where(inside[:, t, None], step + scores[:, t], forward[:, t - 1])
    norm = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])[:, None]
    backward = np.zeros_like(scores)
    edges = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        onward = transition + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
        on = inside[:, t + 1, None]
        backward[:, t] = np.where(on, np.logaddexp(onward[:, :, 0], onward[:, :, 1]), 0.0)
        joint = np.exp(forward[:, t, :, None] + onward - norm[..., None])
        edges += (joint * on[..., None]).sum(0)
    marginal = np.exp(forward + backward - norm[:, None]) * inside[..., None]
    features = marginal.reshape(-1, 2).T @ bits.reshape(-1, bits.shape[-1])
    return features, edges, marginal[:, 0].sum(0)


def train(
    df: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    max_lines: int = MAX_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> LineCrf:
    """The field trained on a bounded sample of labelled documents, see the module."""
    good = F.col(label_col) == 1
    chosen = None
    for side in (good, ~good):
        part = (
            labels.filter(side & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), good.cast("int").alias("good"))
            .distinct()
            .orderBy(F.xxhash64("id"), "id")
            .limit(sample)
        )
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most twice ``sample`` rows of two numbers, and as many texts drawn by them: small
    # however large the tables are and however many rows carry an id.
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def make():
        def work(columns):
            found = [line_sequence(text) for text in columns["text"]]
            return {
                "id": columns["id"],
                "good": columns["good"],
                "masks": [m if len(m) <= max_lines else [] for m, _ in found],
                "sizes": [s if len(s) <= max_lines else [] for _, s in found],
            }

        return work

    drawn = map_batches(
        drawn_texts(rows, chosen),
        make,
        "id long, good int, masks array<int>, sizes array<int>",
    )
    found = sorted(
        {(r.id, r.good, tuple(r.masks), tuple(r.sizes)) for r in drawn.collect()}
    )
    found = [r for r in found if r[2]]
    model = LineCrf.untrained()
    if len({r[1] for r in found}) < 2:
        return model
    masks = [list(r[2]) for r in found]
    marks = [[r[1]] * len(r[2]) for r in found]
    for _ in range(3):
        model = model.fit(masks, marks)
        for i, (_, is_good, sequence, sizes) in enumerate(found):
            if not is_good:
                decoded = model.decode(list(sequence))
                kept = sum(n for n, label in zip(sizes, decoded) if label)
                marks[i] = decoded if 2 * kept <= sum(sizes) else [0] * len(sequence)
    return model


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that stand twice or more in the text."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(word, len(known)) for word in words], dtype=np.int64)
    pair = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 1 << 20:  # the product of three would not fit 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, place, count = np.unique(
        pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True
    )
    again = count[place] > 1
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words (between ASCII white space), their characters, symbols, repeated lines, words in
    repeated windows."""
    data = text.encode() if text else b""
    words = data.split()
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r")) if text else 0
    lines = [line for line in data.split(b"\n") if line.split()]
    symbols = sum(data.count(symbol.encode()) for symbol in SYMBOLS)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


def judge(
    df: DataFrame,
    model: LineCrf,
    min_share: float = MIN_SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row with the columns ``keep`` (default: the id) and ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``content`` (a mark per line with a
    word), ``content_share``, ``base_failed`` and ``kept``."""
    packed, kept = carried([id_col] if keep is None else keep, text_col)
    with_text = text_col in (keep or ())

    def make():
        def work(columns):
            out = {name: [] for name in names}
            for text in columns["text"]:
                base = base_counts(text)
                for name, value in zip(names, base):
                    out[name].append(value)
                masks, sizes = line_sequence(text)
                marks = model.decode(masks)
                words = sum(n for n, mark in zip(sizes, marks) if mark)
                out["content"].append([bool(mark) for mark in marks])
                out["content_share"].append(words / sum(sizes) if sizes else 0.0)
            return columns | out

        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        names += ["content", "content_share"]
        return work

    rows = df.select(packed, F.col(text_col).alias("text"))
    row_type = rows.schema["row"].dataType.simpleString()
    found = map_batches(
        rows,
        make,
        f"row {row_type}, {'text string, ' * with_text}n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        " n_repeat_words long, content array<boolean>, content_share double",
    )
    failed = base_failed()
    return found.select(
        *kept,
        *[F.col(name) for name in found.columns if name not in ("row", "text")],
        failed.alias("base_failed"),
        (~failed & (F.col("content_share") >= min_share)).alias("kept"),
    )


def base_failed() -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
