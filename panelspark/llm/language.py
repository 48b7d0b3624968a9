"""OP 3: language identification of whole, possibly mixed-language texts.

Learning: letter n-grams of orders 1 to 3 and whole words, hashed into
``BUCKETS`` per language, counted by Spark over all labelled documents it may
learn from; shares of each script's letters per language come from the same
counts.

Labelling: a word's letters name its script, and the script's languages are
its candidates; its score for a language is the mean log-probability of its
n-grams plus that of the word.  Viterbi over the words of the whole text,
with a penalty for each switch, gives every word a language and so spans.
The text's language is the one with most letters, the score their share.
Words without letters take their neighbours' label and have no weight.

Texts are worked on side by side, one word of each at a time, so memory is
the slice's words and never a text-by-text Python loop.

``keep_known`` drops what fits no learned language: texts most of whose
letters are of scripts that no language was seen in, and texts whose n-grams'
mean log-probability a letter lies further below the usual one of their language
than ``MARGIN`` times what all but ``FIT_TAIL`` of that language's labelled documents
kept out of the learning do (``level``).  The distance is taken in units of 1 + sqrt(``FIT_LETTERS`` / letters),
since short texts vary more.

Null texts and texts without letters are ``und`` with score 0 and no spans;
so is everything when no labelled text is given.  Ties go to the
first language in order.  Other columns of the input play no part.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm import word_tokens as WT
from panelspark.llm.common import byte_slices, release, ship, worker_state

ship(__name__)

BUCKETS = 1 << 16
SWITCH = 14.0              # nats for a change of language
SCRIPT_SHARE = 0.002       # of a language's letters, to make it a candidate for a script
UNSEEN = 30.0              # nats against a language that isn't a candidate
FIT_TAIL = 0.01
FIT_LETTERS = 100
MARGIN = 5.5               # between the worst labelled texts (3.3 to 5.3 of their tails) and foreign ones (7.2 and more)
FIT_PRIOR = 20             # texts that the mean tail of all languages counts for
_SLICE = 4 << 20

# First and last code point of the scripts' main blocks.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x137F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}


SPANS = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("first_word", T.IntegerType()),
                                  T.StructField("words", T.IntegerType())]))


def script_table() -> np.ndarray:
    """Code point -> 0 (no letter), 1.. (script in order of SCRIPTS), last: other letters."""
    def make():
        other = len(SCRIPTS) + 1
        table = np.fromiter((other if unicodedata.category(chr(c))[0] == "L" else 0 for c in range(0x110000)), np.uint8, 0x110000)
        for k, ranges in enumerate(SCRIPTS.values(), 1):
            for a, b in ranges:
                part = table[a:b + 1]
                part[part > 0] = k
        return table
    return worker_state("script_table", make)


class Words:
    """Letters and hashed features of distinct words."""

    def __init__(self, words: pa.Array):
        lower = pc.utf8_lower(words)
        n = pc.utf8_length(lower).to_numpy().astype(np.int64)
        cp = np.frombuffer("".join(lower.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4")
        self.n = len(n)
        script = script_table()[cp]
        of = np.repeat(np.arange(len(n)), n)
        # one boundary before, between and after the words; anything but a letter is a boundary
        line = np.zeros(len(cp) + len(n) + 1, np.uint64)
        at = np.arange(len(cp)) + of + 1
        line[at] = np.where(script > 0, cp, 0)
        keep = np.flatnonzero(script)
        self.of, self.script = of[keep], script[keep]
        a, b, c = line[at[keep] - 1], line[at[keep]], line[at[keep] + 1]
        self.grams = [self._bucket(b, 1), self._bucket(a * np.uint64(0x110000) + b, 2),
                      self._bucket((a * np.uint64(0x110000) + b) * np.uint64(0x110000) + c, 3)]
        self.letters = np.bincount(self.of, minlength=self.n)
        # the word as a whole: a polynomial of its letters
        first = np.cumsum(self.letters) - self.letters
        place = np.arange(len(keep)) - first[self.of]
        power = np.ones(int(place.max()) + 1 if len(place) else 1, np.uint64)
        power[1:] = np.uint64(0x9E3779B97F4A7C15)
        power = np.multiply.accumulate(power)
        has = np.flatnonzero(self.letters)
        whole = np.zeros(self.n, np.uint64)
        if len(has):
            whole[has] = np.add.reduceat(b * power[place], first[has])
        self.whole = self._bucket(whole, 4)
        # a word's script: that of its first letter
        self.word_script = np.zeros(self.n, np.int64)
        self.word_script[has] = self.script[first[has]]

    @staticmethod
    def _bucket(key: np.ndarray, order: int) -> np.ndarray:
        h = (key + np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h = h * np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(48)).astype(np.int64) % BUCKETS

    def count(self, times: np.ndarray, out: np.ndarray) -> None:
        """Add to ``out`` (5, BUCKETS) the four features and the scripts, each word ``times`` times."""
        keep = np.flatnonzero(times[self.of])                # a language's words are few of a slice's
        w = times[self.of[keep]]
        for k, g in enumerate(self.grams):
            out[k] += np.bincount(g[keep], w, BUCKETS)
        out[3] += np.bincount(self.whole, times * (self.letters > 0), BUCKETS)
        out[4, :len(SCRIPTS) + 2] += np.bincount(self.script[keep], w, len(SCRIPTS) + 2)


class Model:
    """Log-probabilities (4, BUCKETS, languages) and candidates per script."""

    def __init__(self, langs: list[str], logp: np.ndarray, against: np.ndarray, known: np.ndarray):
        self.langs, self.logp, self.against, self.known = langs, logp, against, known

    @staticmethod
    def of(langs: list[str], counts: np.ndarray) -> "Model":
        logp = np.stack([np.log((c + 0.3) / (c.sum(axis=1, keepdims=True) + 0.3 * BUCKETS)).T
                              for c in counts[:, :4].transpose(1, 0, 2)]).astype(np.float32)
        letters = counts[:, 4, :len(SCRIPTS) + 2]
        share = letters / np.maximum(1, letters.sum(axis=1, keepdims=True))
        cand = share >= SCRIPT_SHARE
        known = cand.any(axis=0)
        cand[:, ~known] = True        # a script that no language was seen in: all remain
        return Model(langs, logp, np.where(cand.T, 0, -UNSEEN).astype(np.float32), known)

    def scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Score of each word for each language, and of its n-grams alone, a letter."""
        out = np.zeros((words.n, len(self.langs)), np.float32)
        has = np.flatnonzero(words.letters)
        if len(has):
            first = (np.cumsum(words.letters) - words.letters)[has]
            for lo in range(0, len(has), 100_000):
                part = slice(lo, lo + 100_000)
                a = first[part][0]
                b = first[lo + 100_000] if lo + 100_000 < len(has) else len(words.of)
                grams = sum(self.logp[k][words.grams[k][a:b]] for k in range(3))
                out[has[part]] = np.add.reduceat(grams, first[part] - a, axis=0) / 3
            grams = out / np.maximum(1, words.letters)[:, None]
            out[has] += self.logp[3][words.whole[has]] + self.against[words.word_script[has]]
            return out, grams
        return out, out


def viterbi(scores: np.ndarray, word: np.ndarray, offsets: np.ndarray, switch: float) -> np.ndarray:
    """Language number of every word; texts are ``word[offsets[i]:offsets[i + 1]]``."""
    n = np.diff(offsets)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    label = np.zeros(len(word), np.int16)
    if not len(order):
        return label
    start, size = offsets[:-1][order], n[order]
    steps = int(size[0])
    active = np.searchsorted(-size, -np.arange(steps), side="left")     # texts with more than t words
    v = scores[word[start]].astype(np.float64)
    jump, source = [None], [None]
    for t in range(1, steps):
        a = active[t]
        now = v[:a]
        top = now.argmax(axis=1)
        best = now[np.arange(a), top] - switch
        moved = now < best[:, None]
        jump.append(moved)
        source.append(top.astype(np.int16))
        v[:a] = np.where(moved, best[:, None], now) + scores[word[start[:a] + t]]
    state = v.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        label[start[:a] + t] = state[:a]
        if t:
            rows = np.arange(a)
            state[:a] = np.where(jump[t][rows, state[:a]], source[t], state[:a])
    return label


def labelled(docs: DataFrame, text_col: str, lang_col: str, rows: Column) -> DataFrame:
    """Text and label (text_, lang_) of all ``rows`` that have a label."""
    return (docs.filter(rows & F.col(lang_col).isNotNull())
            .select(F.col(text_col).cast("string").alias("text_"), F.col(lang_col).cast("string").alias("lang_")))


def train(docs: DataFrame, text_col: str, lang_col: str, id_col: str, rows: Column) -> Model | None:
    """Model from all labelled ``rows``; ids play no part."""
    texts = labelled(docs, text_col, lang_col, rows)
    langs = sorted(r["lang_"] for r in texts.select("lang_").distinct().collect())       # one row a language
    if not langs:
        return None
    number = {lang: k for k, lang in enumerate(langs)}

    def task(batches):
        total = np.zeros((len(langs), 5, BUCKETS))
        for batch in batches:
            for part in byte_slices(batch, 0, _SLICE):
                words, index, offsets = WT.split_words(part.column(0))
                index = index.to_numpy()
                of = np.repeat([number[x] for x in part.column(1).to_pylist()], np.diff(offsets))
                w = Words(words)
                for k in np.unique(of):
                    w.count(np.bincount(index[of == k], minlength=len(words)), total[k])
        lang, kind, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array((kind * BUCKETS + bucket).astype(np.int32)), pa.array(total[lang, kind, bucket])],
            names=["lang", "cell", "n"])

    # languages x buckets cells at most, whatever the number of documents
    cells = (texts.mapInArrow(task, "lang int, cell int, n double").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((len(langs), 5 * BUCKETS))
    counts[cells["lang"], cells["cell"]] = cells["n"]
    return Model.of(langs, counts.reshape(len(langs), 5, BUCKETS))


def told(df: DataFrame, model: Model | None, text_col: str, keep: list[str], switch: float = SWITCH, spans: bool = True,
         fit: bool = False) -> DataFrame:
    """``row_`` (the columns ``keep`` but the text), ``lang_pred``, ``score``
    and, if asked for, ``spans``, ``fit`` (mean log-probability a letter of the
    n-grams, over the letters of learned scripts), ``letters`` (number of
    these), ``strange`` (number of the others) and, if kept, ``text_``."""
    others = [c for c in keep if c != text_col]
    back = len(others) < len(keep)          # the text goes to Python once, and back only if kept
    src = df.select(F.struct(*[F.col(c) for c in others] or [F.lit(0)]).alias("row_"), F.col(text_col).cast("string").alias("text_"))
    shared = df.sparkSession.sparkContext.broadcast(model and (model.langs, model.logp, model.against, model.known))   # languages x buckets numbers: fixed by the model
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32())]))

    def work(m, part):          # a slice's arrays end with it
        rows = part.num_rows
        lang, score = np.full(rows, -1), np.zeros(rows)
        mean, near, far = np.zeros(rows), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        found = [[] for _ in range(rows)]
        words, index, offsets = WT.split_words(part.column(1))
        if m is not None and len(words):
            index = index.to_numpy()
            w = Words(words)
            scores, grams = m.scores(w)
            label = viterbi(scores, index, offsets, switch)
            of = np.repeat(np.arange(rows), np.diff(offsets))
            weight = np.bincount(of * len(m.langs) + label, w.letters[index], rows * len(m.langs)).reshape(rows, -1)
            total = weight.sum(axis=1)
            some = total > 0
            lang[some] = weight[some].argmax(axis=1)
            score[some] = weight[some].max(axis=1) / total[some]
            if fit:
                size = np.where(m.known[w.word_script], w.letters, 0)[index]
                near = np.bincount(of, size, rows).astype(np.int64)
                far = total.astype(np.int64) - near
                mean = np.bincount(of, grams[index, label] * size, rows) / np.maximum(1, near)
            if spans:
                cut = np.flatnonzero(np.diff(label) | np.diff(of)) + 1
                head = np.concatenate([[0], cut]) if len(of) else cut
                size = np.diff(np.append(head, len(of)))
                for h, s in zip(head.tolist(), size.tolist()):
                    r = of[h]
                    if some[r]:
                        found[r].append({"lang": m.langs[label[h]], "first_word": int(h - offsets[r]), "words": s})
        names = np.array([*(m.langs if m else []), "und"], object)
        cols = [part.column(0), pa.array(names[lang].tolist(), pa.string()), pa.array(score)]
        names_ = ["row_", "lang_pred", "score"]
        if spans:
            cols.append(pa.array(found, span_type))
            names_.append("spans")
        if fit:
            cols += [pa.array(mean), pa.array(near), pa.array(far)]
            names_ += ["fit", "letters", "strange"]
        if back:
            cols.append(part.column(1))
            names_.append("text_")
        return pa.RecordBatch.from_arrays(cols, names=names_)

    def task(batches):
        m = Model(*shared.value) if shared.value else None
        for batch in batches:
            for part in byte_slices(batch, 1, _SLICE):
                yield work(m, part)
        release()

    schema = src.select("row_").schema.add("lang_pred", "string").add("score", "double")
    if spans:
        schema = schema.add("spans", SPANS)
    if fit:
        schema = schema.add("fit", "double").add("letters", "long").add("strange", "long")
    if back:
        schema = schema.add("text_", "string")
    return src.mapInArrow(task, schema)


def unpacked(text_col: str, keep: list[str]) -> list[Column]:
    """The columns ``keep`` of a table of ``told``."""
    return [(F.col("text_") if c == text_col else F.col("row_").getField(c)).alias(c) for c in keep]


def identify(df: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None,
             switch: float = SWITCH, spans: bool = True) -> DataFrame:
    """The columns ``keep`` of ``df`` with ``lang_pred``, ``score`` and, if
    asked for, ``spans`` (language, first word, words).  Columns of ``keep``
    with these names are not allowed."""
    keep = keep or []
    own = ["lang_pred", "score"] + ["spans"] * spans
    return told(df, model, text_col, keep, switch, spans).select(*unpacked(text_col, keep), *own)


def unit() -> Column:
    """Of a text's distance from the usual fit: larger for short texts."""
    return 1 + F.sqrt(FIT_LETTERS / F.greatest(F.col("letters"), F.lit(1)))


def level(docs: DataFrame, model: Model, text_col: str, lang_col: str, id_col: str, rows: Column) -> dict[str, tuple[float, float]] | None:
    """For each language the usual fit and the largest distance below it (in
    ``unit``) of a text that is kept, from all labelled ``rows`` that nothing was
    learned from and that are told as their label.

    The tail of a language with few such texts is uncertain: it is shrunk towards
    the mean tail of all languages, as if ``FIT_PRIOR`` texts had shown it, but
    never below what its own texts show.  A language without any has no
    entry: its texts can't be judged and stay."""
    fits = told(labelled(docs, text_col, lang_col, rows), model, "text_", ["lang_"], spans=False, fit=True).filter("letters > 0 and lang_pred = row_.lang_").select("lang_pred", "fit", "letters")
    usual = fits.groupBy("lang_pred").agg(F.percentile_approx("fit", F.array(F.lit(0.5), F.lit(0.25)), 10_000).alias("m"), F.count(F.lit(1)).alias("n"))
    far = (fits.join(F.broadcast(usual), "lang_pred")                                       # a row per language
           .withColumn("d", (F.col("m")[0] - F.col("fit")) / unit()).groupBy("lang_pred")
           .agg(F.percentile_approx("d", 1 - FIT_TAIL, 10_000).alias("far"), F.first("m").alias("m"), F.first("n").alias("n")).collect())
    if not far:
        return None
    whole = sum(r["n"] for r in far)
    common = sum(r["far"] * r["n"] for r in far) / whole
    out = {}
    for r in far:
        shrunk = (r["n"] * r["far"] + FIT_PRIOR * common) / (r["n"] + FIT_PRIOR)
        out[r["lang_pred"]] = float(r["m"][0]), MARGIN * max(float(r["far"]), float(shrunk), float(r["m"][0] - r["m"][1]))
    return out


def keep_known(df: DataFrame, model: Model, at: dict[str, tuple[float, float]] | None, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text fits the language it is told as; any column names."""
    rows = told(df, model, text_col, df.columns, spans=False, fit=True).filter("lang_pred <> 'und' and letters >= strange")
    if at:
        usual, far = (F.create_map(*[F.lit(x) for k, v in at.items() for x in (k, v[i])])[F.col("lang_pred")] for i in (0, 1))     # as many as languages
        rows = rows.filter(usual.isNull() | ((usual - F.col("fit")) / unit() <= far))
    return rows.select(*unpacked(text_col, df.columns))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from: remainder 1 of the id's CRC-32 by 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op3_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, "text", "lang", "doc_id", ~held_out())
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, model, keep=["doc_id", "held_out"], spans=False)
