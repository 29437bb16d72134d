"""Language identification by a linear-chain conditional random field over the words of a text.

Words are runs of letters, lower-cased. A word's features are itself (the lexicon), its prefixes and suffixes and its
character n-grams with the word's ends marked, hashed into a table of weights for each language; transitions between
the languages of neighbouring words are learned with them, on windows of texts and on windows put together from two
languages. Forward-backward gives each word a probability for each language; the words' sum names the text's language,
so a text that switches is labelled by its larger part and its runs of languages can be read off.

Fitting takes SAMPLE different texts, or all if there are fewer, of every language, chosen by a hash of the text whatever
its length; of a long text it takes a run of neighbouring words of at most LONGEST characters in all. From LANGUAGES
languages on, each has fewer texts and the table of weights fewer rows, at least one text and 2 ** 12 rows, so what the
driver fits and sends stays the same size; no language is left out. Labelling reads whole texts: forward-backward runs over all words of a slice of texts side by
side, in blocks whose products are chained, which is exact.

Defined results: a null text or one without letters is "und" with score 0; with no labelled row to learn from every
text is; rows are kept as often as they come; a null doc_id is not held out; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import checkpointed, written

SAMPLE = 250
LANGUAGES = 64  # with a full sample and table
LONGEST = 8_000
TABLE = 1 << 18
WINDOW = 32  # words to a training sequence
BATCH = 256  # sequences to a step
EPOCHS = 3
RATE = 0.5
DECAY = 1e-6
BLOCK = 64  # words whose transitions are multiplied before blocks are chained
SLICE = 100_000  # words labelled at a time
MOST_WORDS = 300_000  # words whose weights a worker keeps
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the documents, never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str | None) -> list[str]:
    found = LETTERS.findall(text.lower()) if text else []
    return [w for w in found if w.isalpha() or any(c.isalpha() for c in w)]


def features(word: str, table: int = TABLE) -> list[int]:
    """Places in a table of weights."""
    n = len(word)
    marked = f"<{word}>"
    names = [f"w{word}"]
    names += [f"p{word[:k]}" for k in range(1, min(4, n) + 1)]
    names += [f"s{word[-k:]}" for k in range(1, min(4, n) + 1)]
    names += [marked[k : k + size] for size in (2, 3) for k in range(n + 3 - size)]
    hashed = zlib.crc32
    return [hashed(x.encode()) % table for x in names]


def places(words: list[str], table: int = TABLE) -> tuple[np.ndarray, np.ndarray]:
    """All words' places in one array, and where each word's begin."""
    found = [features(w, table) for w in words]
    starts = np.cumsum([0] + [len(x) for x in found[:-1]])
    return np.fromiter((p for x in found for p in x), np.int64), starts


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        flat, starts = places(words, len(self.weights))
        return np.add.reduceat(self.weights[flat], starts, axis=0)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def _likely(emissions: np.ndarray) -> np.ndarray:
    return np.exp(emissions - emissions.max(axis=-1, keepdims=True))


def fit(texts: list[tuple[str, list[str]]], seed: int = 5) -> Model:
    """Model from (language, words); stochastic gradient steps on the log-likelihood of training windows."""
    languages = sorted({lang for lang, _ in texts})
    label = {x: k for k, x in enumerate(languages)}
    size = len(languages)
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    windows: list[tuple[np.ndarray, np.ndarray]] = []
    for lang, words in texts:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64)
        for at in range(0, len(ids), WINDOW):
            part = ids[at : at + WINDOW]
            windows.append((part, np.full(len(part), label[lang])))
    table = max(1 << 12, TABLE >> max(0, (size - 1) // LANGUAGES).bit_length())
    flat, starts = places(list(vocabulary), table)
    counts = np.diff(np.append(starts, len(flat)))
    weights, sums = np.zeros((table, size)), np.full((table, size), 1e-6)
    transitions, start = np.zeros((size, size)), np.zeros(size)
    t_sums, s_sums = np.full((size, size), 1e-6), np.full(size, 1e-6)

    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            chosen = [windows[k] for k in order[at : at + BATCH]]
            for k in range(0, len(chosen) - 1, 3):  # a third switches language on the way
                (a, la), (b, lb) = chosen[k], chosen[k + 1]
                cut = int(rng.integers(0, WINDOW))
                chosen[k] = np.concatenate([a[:cut], b[cut:]]), np.concatenate([la[:cut], lb[cut:]])
            chosen = [c for c in chosen if len(c[0])]
            if not chosen:
                continue
            ids, gold = np.zeros((len(chosen), WINDOW), np.int64), np.zeros((len(chosen), WINDOW), np.int64)
            there = np.zeros((len(chosen), WINDOW), bool)
            for k, (x, y) in enumerate(chosen):
                ids[k, : len(x)], gold[k, : len(y)], there[k, : len(x)] = x, y, True
            used, where = np.unique(ids[there], return_inverse=True)
            lengths = counts[used]
            begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            at_places = flat[np.repeat(starts[used] - begins, lengths) + np.arange(lengths.sum())]
            emitted = np.zeros((*ids.shape, size))
            emitted[there] = np.add.reduceat(weights[at_places], begins, axis=0)[where]
            single, pairs, first = _expected(emitted, there, transitions, start)

            one = np.eye(size)
            excess = (single - one[gold])[there]
            by_word = np.zeros((len(used), size))
            np.add.at(by_word, where, excess)
            spread = np.repeat(by_word, lengths, axis=0)
            touched, back = np.unique(at_places, return_inverse=True)
            grad = np.column_stack([np.bincount(back, spread[:, k], len(touched)) for k in range(size)]) / len(chosen)
            sums[touched] += grad**2
            weights[touched] -= RATE * grad / np.sqrt(sums[touched]) + DECAY * weights[touched]
            both = there[:, 1:] & there[:, :-1]
            observed = np.zeros((size, size))
            np.add.at(observed, (gold[:, :-1][both], gold[:, 1:][both]), 1)
            t_grad = (pairs - observed) / len(chosen)
            t_sums += t_grad**2
            transitions -= RATE * t_grad / np.sqrt(t_sums)
            s_grad = (first - one[gold[:, 0]].sum(axis=0)) / len(chosen)
            s_sums += s_grad**2
            start -= RATE * s_grad / np.sqrt(s_sums)
    return Model(languages, weights.astype(np.float32), transitions, start)


def _expected(emitted: np.ndarray, there: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Marginals of each word, summed marginals of neighbours and of first words, of sequences side by side."""
    likely, step = np.where(there[..., None], _likely(emitted), 1.0), np.exp(transitions)
    n, length, size = emitted.shape
    forward, backward = np.empty((n, length, size)), np.empty((n, length, size))
    forward[:, 0] = _unit(np.exp(start) * likely[:, 0])
    for t in range(1, length):
        forward[:, t] = np.where(there[:, t, None], _unit(forward[:, t - 1] @ step * likely[:, t]), forward[:, t - 1])
    backward[:, -1] = 1
    for t in range(length - 2, -1, -1):
        come = _unit((likely[:, t + 1] * backward[:, t + 1]) @ step.T)
        backward[:, t] = np.where(there[:, t + 1, None], come, backward[:, t + 1])
    single = _unit(forward * backward)
    pairs = np.zeros((size, size))
    for t in range(1, length):
        joint = forward[:, t - 1, :, None] * step * (likely[:, t] * backward[:, t])[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True))[there[:, t]].sum(axis=0)
    return single, pairs, single[:, 0].sum(axis=0)


def marginals(emitted: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """Forward-backward over the words of many texts in one chain; first marks the words that begin a text.

    A first word's transition does not depend on the word before it, which parts the texts exactly. Blocks of the
    chain are multiplied side by side, then linked one after the other, then filled in side by side.
    """
    n, size = emitted.shape
    blocks = -(-n // BLOCK)
    likely = np.ones((blocks * BLOCK, size))
    likely[:n] = _likely(emitted.astype(np.float64))
    begins = np.ones(blocks * BLOCK, bool)  # what fills up the last block is texts of its own
    begins[:n] = first
    likely, begins = likely.reshape(blocks, BLOCK, size), begins.reshape(blocks, BLOCK)
    step = _unit(np.exp(model.transitions).ravel()).reshape(size, size)
    fresh = np.broadcast_to(_unit(np.exp(model.start)), (size, size))

    def move(t: int) -> np.ndarray:
        return np.where(begins[:, t, None, None], fresh, step) * likely[:, t, None, :]

    product = move(0)
    for t in range(1, BLOCK):
        product = product @ move(t)
        product /= product.max(axis=(1, 2), keepdims=True)
    into, out_of = np.empty((blocks, size)), np.empty((blocks, size))
    into[0], out_of[-1] = 1 / size, 1
    for b in range(1, blocks):
        into[b] = _unit(into[b - 1] @ product[b - 1])
        out_of[-1 - b] = _unit(product[-b] @ out_of[-b])
    forward, backward = np.empty((blocks, BLOCK, size)), np.empty((blocks, BLOCK, size))
    now = into
    for t in range(BLOCK):
        now = _unit((now[:, None, :] @ move(t))[:, 0])
        forward[:, t] = now
    now = out_of
    for t in range(BLOCK - 1, -1, -1):
        backward[:, t] = now
        now = _unit((move(t) @ now[:, :, None])[:, :, 0])
    return _unit(forward * backward).reshape(-1, size)[:n]


class Labeller:
    """A model with the emissions of words met before."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.emitted = np.empty((0, len(model.languages)), np.float32)

    def _emissions(self, texts: list[list[str]]) -> np.ndarray:
        if len(self.rows) > MOST_WORDS:
            self.rows.clear()
            self.emitted = self.emitted[:0]
        new = list(dict.fromkeys(w for words in texts for w in words if w not in self.rows))
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.emitted = np.concatenate([self.emitted, self.model.emissions(new)])
        rows = np.fromiter((self.rows[w] for words in texts for w in words), np.int64)
        return self.emitted[rows]

    def label(self, texts: list[list[str]]) -> list[tuple[str, float, list[tuple[str, int]]]]:
        """(language, score, runs of (language, words)) of each text."""
        found: list = [(UNKNOWN, 0.0, [])] * len(texts)
        worded = [k for k, words in enumerate(texts) if words]
        names = self.model.languages
        if not worded or not names:
            return found
        lengths = np.array([len(texts[k]) for k in worded])
        starts = np.cumsum(lengths) - lengths
        first = np.zeros(lengths.sum(), bool)
        first[starts] = True
        each = marginals(self._emissions([texts[k] for k in worded]), first, self.model)
        sums = np.add.reduceat(each, starts, axis=0)
        best = sums.argmax(axis=1)
        scores = sums[np.arange(len(best)), best] / lengths
        top = each.argmax(axis=1)
        first[1:] |= top[1:] != top[:-1]
        begins = np.flatnonzero(first)
        sizes = np.diff(np.append(begins, len(top))).tolist()
        runs = [(names[k], n) for k, n in zip(top[begins].tolist(), sizes)]
        cut = np.searchsorted(begins, np.append(starts, len(top))).tolist()
        for k, b, s, x, y in zip(worded, best.tolist(), scores.tolist(), cut, cut[1:]):
            found[k] = names[b], min(1.0, s), runs[x:y]
        return found


def run_of(words: list[str], place: int, longest: int = LONGEST) -> list[str]:
    """Neighbouring words of at most so many characters, a blank after each counted; all words where they fit."""
    ends = np.cumsum([len(w) + 1 for w in words])
    if not words or ends[-1] <= longest + 1:
        return words
    starts = ends - [len(w) + 1 for w in words]
    first = place % (int(np.searchsorted(starts, ends[-1] - longest - 1, "right")))
    last = int(np.searchsorted(ends, starts[first] + longest + 1, "right"))
    return words[first:last] or [words[first][:longest]]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column(2), batch.column(1))
        found = [" ".join(run_of(words_of(text.as_py()), h.as_py())) for text, h in rows]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["lang", "h", "words"])


def learn(docs: DataFrame, sample: int = SAMPLE, most_languages: int | None = None) -> Model:
    """Fitted on text and lang of rows that are not held out; of most_languages, if given, those with the most texts.

    Of each language some 1.5 * sample different texts are fetched, as runs of words, so no language takes the place of
    another one. Equal texts of a language are one row before they are counted, and one row before they are fetched.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    usable = usable.where(F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("h"))
    counts = usable.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    counts = checkpointed(counts)
    most = counts.orderBy(F.desc("n"), "lang").limit(most_languages) if most_languages else counts
    languages = most.count()
    sample = max(1, min(sample, sample * LANGUAGES // max(1, languages)))
    # Beside the largest share a few rows more, so that a small sample is full all the same.
    share = F.least(F.lit(1.0), F.lit(1.5 * sample + 50) / F.col("n"))
    # A table of known size: the planner sends it to all tasks while it is small, so no text moves by language.
    chosen = usable.join(written(most.select("lang", share.alias("share")), "languages"), "lang")
    chosen = chosen.where((F.col("h") / F.lit(2.0**64) + 0.5) <= F.col("share")).select("lang", "h", "text").distinct()
    texts: dict[str, list[list[str]]] = {}
    for row in sorted(chosen.mapInArrow(_runs, "lang string, h long, words string").collect(), key=lambda r: (r.h, r.words)):
        if len(texts.setdefault(row.lang, [])) < sample and row.words:
            texts[row.lang].append(row.words.split(" "))
    return fit([(lang, words) for lang in sorted(texts) for words in texts[lang]])


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns with lang_pred, score and runs: array of (lang, words) along the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most TABLE x LANGUAGES weights, or 2 ** 12 a language
    picked = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"])
    runs = "array<struct<lang:string,words:bigint>>"
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]]
    kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
    names = [*keep, "lang_pred", "score", "runs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller(shared.value)
        for batch in batches:
            found, group, held = [], [], 0
            for value in batch.column(batch.num_columns - 1):
                group.append(words_of(value.as_py()))
                held += len(group[-1])
                if held >= SLICE:
                    found += own.label(group)
                    group, held = [], 0
            found += own.label(group)
            columns = [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([[{"lang": a, "words": n} for a, n in x[2]] for x in found], kind),
            ]
            yield pa.record_batch([*batch.columns[:-1], *columns], names)

    return picked.mapInArrow(run, ", ".join([*kept, "lang_pred string", "score double", f"runs {runs}"]))
