"""OP 10: licence scan with a trained paragraph classifier, native.

Paragraphs are the lines of a text.  A multinomial logistic regression with
an elastic-net penalty (Spark ML) over word n-grams of orders 1 to 3 tells the licence
families and ``unknown`` apart.  It is trained here:

* positives: the templates (``licence_texts``, or a table of one's own) and their spans of words;
* unknown: the different paragraphs of all documents, without those that a template covers;
* features: the templates' n-grams, but for those frequent among the unknown
  paragraphs.  Other n-grams have no weight, so the model is as sparse as the templates.

Calibration: a part of the unknown paragraphs and template spans is kept out of the fit; a
family is predicted where its probability passes the level that all but
``FALSE_SHARE`` of the kept-out unknown paragraphs stay below, and 1/2; below it the
paragraph is unknown.

A line of SPDX identifiers is taken apart (``MIT OR Apache-2.0`` is two).

Confirmation: a predicted paragraph must share its words with a template of
its family: the share of its 3-grams that the template has, or of the
template's that it has, reaches ``CONFIRM`` (both shares for headings and
identifiers, which stand for a whole paragraph; texts below three words must be
equal).  A paragraph whose words agree with a template only across a negation
("not licensed under ...") does not declare it.  A confirmed paragraph names the template.  All families that pass the level against unknown are tried,
closest template first; a further one counts by the 3-grams that those before it
don't have, so one notice isn't two families; a line that several families'
templates share word for word follows the other lines of its text, else the likeliest.  A document has all the families
of its paragraphs.

Everything on the way from rows to result is a built-in expression, join or
aggregation; the weights are one row per n-gram and the templates one row per
paragraph, both bounded by the table of templates.  A paragraph is named by two
64-bit hashes of its words and looked up once, however often it occurs: training and
scan read the same table (``looked_up``), a row per different paragraph with the numbers of the templates' n-grams in it.

Null and empty texts have no paragraphs and are ``unknown``; results belong to
texts (told apart by two 64-bit hashes), so null and repeated ids are rows
of their own and copies agree; ties between families or paragraphs go to the first.  Other
columns of the input play no part.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import ship
from panelspark.llm.licence_texts import HEADINGS, IDENTIFIERS, PARAGRAPHS
from panelspark.session import checkpoint_dir

ship(__name__)

FREQUENT = 0.002           # share of unknown paragraphs that makes an n-gram no feature
FALSE_SHARE = 0.0005
CONFIRM = 0.6
MIN_SPAN = 0.3             # of a paragraph's words, for spans to train on
LINE_WORDS = 10            # of a line of a wrapped text, likewise
MAX_BROADCAST = 1_000_000  # paragraphs that pass the level
UNKNOWN = "unknown"

NEGATIONS = ["not", "no", "never", "neither", "nor", "without", "cannot", "isn", "aren", "wasn", "weren", "don", "doesn", "t"]
NEGATED = " (?:" + "|".join(NEGATIONS) + ") (?:[^ ]+ )?"           # and then a template's first words
# an identifier's line, and a line that is nothing but an expression of identifiers
SPDX_LINE = r"(?i)SPDX-License-Identifier:\s*([A-Za-z0-9.+()\s-]*[A-Za-z0-9.+)])"
SPDX_BARE = r"^\s*\(?[A-Za-z0-9.+-]+\)?(\s+(OR|AND|WITH)\s+\(?[A-Za-z0-9.+-]+\)?)+\s*$"


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    flat = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(flat, " "), lambda w: w != "")


def grams(ws: Column, order: int) -> Column:
    """Word n-grams of one order, repeats included."""
    out = ws
    for k in range(1, order):
        rest = F.slice(ws, k + 1, 1_000_000_000)
        out = F.zip_with(F.slice(out, F.lit(1), F.greatest(F.size(ws) - k, F.lit(0))), rest, lambda a, b: F.concat_ws(" ", a, b))
    return out


def all_grams(ws: Column) -> Column:
    return F.concat(grams(ws, 1), grams(ws, 2), grams(ws, 3))


TABLE = "family string, template string, text string, exact boolean"


def templates(spark: SparkSession) -> DataFrame:
    """The table of ``licence_texts``: ``exact`` templates stand for a whole paragraph."""
    kinds = (("notice", PARAGRAPHS, False), ("heading", HEADINGS, True), ("identifier", IDENTIFIERS, True))
    return spark.createDataFrame([(f, f"{f}/{kind}-{i}", t, exact) for kind, texts, exact in kinds for f, ts in texts.items()
                                  for i, t in enumerate(ts)], TABLE)


def line_parts(line: Column) -> Column:
    """A line as its paragraphs: an expression of identifiers becomes one identifier line each."""
    # the patterns run only on lines that hold their words
    named = F.when(F.contains(F.lower(line), F.lit("spdx-license-identifier")), F.regexp_extract(line, SPDX_LINE, 1))
    joined = line.contains(" OR ") | line.contains(" AND ") | line.contains(" WITH ")
    ids = F.when(named != "", named).when(joined & line.rlike(SPDX_BARE), line)
    each = F.filter(F.transform(F.split(ids, r"[()\s]+(OR|AND|WITH)[()\s]+|[()]"), F.trim), lambda x: x != "")
    return F.when(F.size(each) > 0, F.transform(each, lambda x: F.concat(F.lit("SPDX-License-Identifier: "), x))).otherwise(F.array(line))


def paragraphs(df: DataFrame, text_col: str) -> DataFrame:
    """The lines of every text."""
    return df.select(F.explode(F.split(F.col(text_col).cast("string"), "\n")).alias("line")).filter("line <> ''")


def named(ws: Column) -> list[Column]:
    """The two hashes that stand for a paragraph's words."""
    return [F.xxhash64(ws).alias("h1"), F.xxhash64(F.lit(1), ws).alias("h2")]


def numbered(spark: SparkSession, rows: list[tuple]) -> list[str]:
    """The n-grams of a table of templates, sorted; their places are their numbers."""
    told = spark.createDataFrame(rows, TABLE).select(all_grams(words(F.col("text"))).alias("grams"))
    return sorted({g for r in told.collect() for g in r["grams"]})


def gram_numbers(df: DataFrame, listed: list[str], *more: str) -> DataFrame:
    """Per (``h1``, ``h2``) of the word arrays ``ws`` (none empty) the distinct numbers ``at`` of their n-grams among ``listed``
    (bounded by the templates), ``of_line`` (number of its 3-grams) and the columns ``more``, the largest of each."""
    table = df.sparkSession.createDataFrame([("", -1), *((g, i) for i, g in enumerate(listed))], "gram string, i int")
    # the pairs once, for themselves and the triples
    pairs = df.select("ws", *more, grams(F.col("ws"), 2).alias("two"))
    room = F.greatest(F.size("ws") - 2, F.lit(0))
    triples = pairs.select("*", F.zip_with(F.slice("two", F.lit(1), room), F.slice("ws", 3, 1_000_000_000), lambda x, y: F.concat_ws(" ", x, y)).alias("three"))
    each = F.explode(F.when(F.size("ws") > 0, F.concat(F.array(F.lit("")), "ws", "two", "three"))).alias("gram")  # "" keeps paragraphs without any
    hits = triples.select(*named(F.col("ws")), F.size(F.array_distinct("three")).alias("of_line"), *more, "ws", "two", "three").select(
        "h1", "h2", "of_line", *more, each).join(F.broadcast(table), "gram")                                    # n-grams of the templates
    found = hits.groupBy("h1", "h2").agg(F.collect_set("i").alias("at"), *[F.max(c).alias(c) for c in ("of_line", *more)])      # of the templates at most
    return found.withColumn("at", F.sort_array(F.filter("at", lambda i: i >= 0)))


def looked_up(docs: DataFrame, text_col: str, listed: list[str]) -> DataFrame:
    """``gram_numbers`` of every different paragraph of all texts, and
    ``line``: it is a line as it stands, not only an identifier taken out of one."""
    lines = paragraphs(docs, text_col).select("line", line_parts(F.col("line")).alias("parts"))
    own = F.array(F.struct(F.col("line").alias("text"), F.lit(True).alias("line")))
    out = F.transform("parts", lambda x: F.struct(x.alias("text"), F.lit(False).alias("line")))
    each = lines.select(F.explode(F.when(F.col("parts")[0] == F.col("line"), own).otherwise(F.concat(own, out))).alias("p"))
    return gram_numbers(each.select(words(F.col("p.text")).alias("ws"), F.col("p.line").alias("line")), listed, "line")


def shingles(ws: Column) -> Column:
    """Distinct 3-grams (all words, if fewer)."""
    return F.array_distinct(F.when(F.size(ws) >= 3, grams(ws, 3)).otherwise(F.array(F.array_join(ws, " "))))


def covered(a: Column, b: Column, exact: Column) -> Column:
    """Larger of the shares of two texts' 3-grams that the other has; the smaller, if ``exact``."""
    both = F.size(F.array_intersect(a, b))
    return F.when(exact, F.least(both / F.size(a), both / F.size(b))).otherwise(F.greatest(both / F.size(a), both / F.size(b)))


def bridged(ws: Column) -> Column:
    """3-grams that exist only once the negations between their words are left out."""
    return F.array_except(shingles(F.filter(ws, lambda w: ~w.isin(NEGATIONS))), shingles(ws))


class Model:
    """Classes, intercepts, weights (gram, w array), the level and the templates' rows."""

    def __init__(self, classes, intercept, weights, level, table):
        self.classes, self.intercept, self.weights, self.level, self.table = classes, intercept, weights, level, table


def rows_of(spark: SparkSession, table: DataFrame | None) -> list[tuple]:
    """A table of templates (``templates``, if not given) on the driver: a row per paragraph of a licence."""
    return [tuple(r) for r in (templates(spark) if table is None else table).select("family", "template", "text", "exact").collect()]


def train(docs: DataFrame, text_col: str = "text", table: DataFrame | None = None, lines: DataFrame | None = None) -> Model:
    """The model of a table of templates (``templates``, if not given; columns as there) against
    the different paragraphs of all ``docs``.  The table comes to the driver: a row per paragraph of a licence.
    ``lines``: ``looked_up`` of the ``docs`` and the table's n-grams, where it is there already."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    rows_ = rows_of(spark, table)
    listed = numbered(spark, rows_)
    classes = [UNKNOWN, *dict.fromkeys(r[0] for r in rows_)]
    told = (spark.createDataFrame(rows_, TABLE).withColumn("ws", words(F.col("text")))
            .withColumn("of_ref", F.size(F.array_distinct(grams(F.col("ws"), 3)))).checkpoint())
    # spans of each template paragraph: whole and shorter ones, down to MIN_SPAN of its words, from several first words
    size = F.size("ws")
    lengths = F.array_distinct(F.array(size, F.least(size, F.lit(LINE_WORDS)),
                                       *[F.greatest(F.ceil(size * x).cast("int"), F.least(size, F.lit(4))) for x in (0.8, 0.5, MIN_SPAN)]))
    lengths = F.when(F.col("exact"), F.array(size)).otherwise(lengths)
    spans = (told.withColumn("n", F.explode(lengths))
             .withColumn("a", F.explode(F.sequence(F.lit(1), size - F.col("n") + 1, F.greatest(F.lit(1), F.floor(size / 8).cast("int")))))
             .select("family", F.slice("ws", F.col("a"), F.col("n")).alias("ws")).distinct())
    lines = (looked_up(docs, text_col, listed).checkpoint() if lines is None else lines).filter("line")
    number_of = spark.createDataFrame(list(enumerate(listed)), "i int, gram string")
    ref = F.broadcast(told.select("template", "of_ref", F.explode(F.array_distinct(grams(F.col("ws"), 3))).alias("gram"))
                      .join(number_of, "gram").select("template", "of_ref", "i"))          # of the templates
    near = (lines.select("h1", "h2", "of_line", F.explode("at").alias("i")).join(ref, "i")
            .groupBy("h1", "h2", "template").agg((F.count(F.lit(1)) / F.least(F.first("of_ref"), F.first("of_line"))).alias("share"))
            .filter("share >= 0.5").select("h1", "h2").distinct())
    plain = lines.join(near, ["h1", "h2"], "left_anti").select("h1", "at").checkpoint()
    n_plain = plain.count()
    frequent = {r["i"] for r in plain.select(F.explode("at").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > max(1, FREQUENT * n_plain)).collect()}                # n-grams of the templates
    vocab = [g for i, g in enumerate(listed) if i not in frequent]
    label = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))])
    spans = (spans.select(F.element_at(label, F.col("family")).alias("label"), *named(F.col("ws")))
             .join(gram_numbers(spans, listed), ["h1", "h2"]).select("label", "h1", "at"))
    rows = (spans.unionByName(plain.select(F.lit(0.0).alias("label"), "h1", "at"))
            .withColumn("out", (F.pmod("h1", F.lit(4)) == 0) & (F.col("label") == 0)))
    if frequent:
        rows = rows.withColumn("at", F.array_except("at", F.array(*[F.lit(i) for i in sorted(frequent)])))
    vec = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(listed)) if i not in frequent], inputCol="grams", outputCol="features", binary=True)
    data = vec.transform(rows.withColumn("grams", F.transform("at", lambda i: i.cast("string")))).select("label", "features", "out").checkpoint()
    fit = LogisticRegression(family="multinomial", regParam=2e-4, elasticNetParam=0.2, maxIter=40, tol=1e-4).fit(data.filter("not out"))
    level = upper_level(fit.transform(data.filter("out")).select((1 - vector_to_array("probability")[0]).alias("p")))
    present = int(fit.coefficientMatrix.numRows)
    coef = fit.coefficientMatrix.toArray()
    weights = [(g, [float(x) for x in coef[:, j]]) for j, g in enumerate(vocab) if abs(coef[:, j]).max() > 0]
    return Model(classes[:present], [float(x) for x in fit.interceptVector.toArray()], weights, max(0.5, level), rows_)


def upper_level(kept_out: DataFrame) -> float:
    """The ``p`` that all but ``FALSE_SHARE`` of the rows don't pass, exactly."""
    total = kept_out.count()
    above = total - max(1, math.ceil(total * (1 - FALSE_SHARE)))
    top = kept_out.orderBy(F.desc("p")).limit(max(1, above + 1)).collect()       # FALSE_SHARE of the rows at most, one number each
    return float(top[-1]["p"]) if top else 0.0


def hashed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_``, ``text_`` and the text's hashes ``k1``, ``k2``."""
    text = F.col(text_col).cast("string")
    whole = F.coalesce(text, F.lit(""))
    return df.select(F.col(id_col).alias("id_"), text.alias("text_"), F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole).alias("k2"))


def confirmed(rows: DataFrame, model: Model, found: tuple[list[str], DataFrame] | None = None) -> DataFrame:
    """One row per text (``k1``, ``k2``), paragraph ``para`` and confirmed
    ``family``: ``overlap``, ``probability`` and ``template``.  ``found``: n-grams and ``looked_up``
    of them in these texts, where it is there already."""
    spark = rows.sparkSession
    checkpoint_dir(spark)
    listed, seen = found or ([g for g, _ in model.weights], None)
    seen = looked_up(rows, "text_", listed) if seen is None else seen
    at = {g: i for i, g in enumerate(listed)}
    weights = F.broadcast(spark.createDataFrame([(at[g], w) for g, w in model.weights], "i int, w array<double>"))   # n-grams of the templates
    k = len(model.classes)
    scored = seen.select("h1", "h2", F.explode("at").alias("i")).join(weights, "i").groupBy("h1", "h2").agg(
        *[F.sum(F.col("w")[c]).alias(f"s{c}") for c in range(k)])
    z = F.array(*[F.exp(F.col(f"s{c}") + model.intercept[c] - (F.col("s0") + model.intercept[0])) for c in range(k)])
    probs = scored.select("h1", "h2", z.alias("z"))
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + x)
    family = F.slice("z", 2, k - 1) if k > 1 else F.array().cast("array<double>")
    names = F.array(*[F.lit(c) for c in model.classes[1:]]) if k > 1 else F.array().cast("array<string>")
    passed = probs.withColumn("total", total).filter(F.lit(1.0) - 1 / F.col("total") > model.level).checkpoint()
    if passed.count() <= MAX_BROADCAST:
        passed = F.broadcast(passed)
    lines = (rows.select("k1", "k2", F.monotonically_increasing_id().alias("uid"), "text_")
             .select("k1", "k2", "uid", F.posexplode(F.split("text_", "\n")).alias("para", "line")).filter("line <> ''")
             .select("k1", "k2", "uid", "para", F.posexplode(line_parts(F.col("line"))).alias("part", "line"))
             .select("k1", "k2", "uid", "para", "part", words(F.col("line")).alias("ws")))
    known = (lines.select("*", *named(F.col("ws"))).join(passed, ["h1", "h2"])
             .select("uid", "k1", "k2", "para", "part", "ws", "total", F.array_max(family).alias("best"),
                     F.explode(F.arrays_zip(names.alias("family"), family.alias("z"))).alias("f")))
    # the likeliest family, and all that pass the level against unknown alone
    told = (known.filter((F.col("f.z") == F.col("best")) | (F.col("f.z") / (1 + F.col("f.z")) > model.level))
            .select("uid", "k1", "k2", "para", "part", shingles(F.col("ws")).alias("own"), bridged(F.col("ws")).alias("bridged"),
                    F.concat(F.lit(" "), F.array_join("ws", " "), F.lit(" ")).alias("line"), F.col("f.family").alias("family"),
                    (F.col("f.z") / F.col("total")).alias("probability")))
    ref = spark.createDataFrame(model.table, TABLE)
    ref = ref.select("family", "template", "exact", words(F.col("text")).alias("ws"))
    ref = F.broadcast(ref.select("family", "template", "exact", shingles(F.col("ws")).alias("ref"),                # the model's templates
                                 F.concat(F.lit(NEGATED), F.array_join(F.slice("ws", 1, 2), " "), F.lit(" ")).alias("negated")))
    # a negation inside a template's words or shortly before them turns their meaning round
    close = (told.join(ref, "family").withColumn("overlap", covered(F.col("own"), F.col("ref"), F.col("exact")))
             .filter((F.col("overlap") >= CONFIRM) & ~F.arrays_overlap("bridged", "ref") & ~F.rlike("line", F.col("negated"))))
    # closest first; each further template by the 3-grams that those before it don't have
    hit = F.array_sort(F.array_intersect("own", "ref")).alias("hit")
    order = F.struct((-F.col("overlap")).alias("o"), (-F.col("probability")).alias("p"), "family", "template", "ref", hit)
    lists = close.groupBy("uid", "para", "part").agg(F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("own").alias("own"),
                                             F.sort_array(F.collect_list(order)).alias("found"))   # of the templates at most
    none = F.struct(F.array().cast("array<string>").alias("seen"), F.filter("found", lambda x: F.lit(False)).alias("kept"))

    def step(acc, x):
        new = F.array_except(x["ref"], acc["seen"])
        right = (F.size(acc["seen"]) == 0) | (F.size(F.array_intersect(new, F.col("own"))) >= CONFIRM * F.greatest(F.size(new), F.lit(1)))
        return F.when(right, F.struct(F.array_union(acc["seen"], x["ref"]).alias("seen"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc)

    # families whose templates the line agrees with equally, word for word: it can't tell them apart
    top = F.col("found")[0]
    alike = F.array_distinct(F.transform(F.filter("found", lambda x: (x["o"] == top["o"]) & (x["hit"] == top["hit"])), lambda x: x["family"]))
    kept = (lists.select("k1", "k2", "para", alike.alias("alike"), top["template"].alias("top"), F.explode(F.aggregate("found", none, step)["kept"]).alias("t"))
            .select("k1", "k2", "para", F.when(F.col("t.template") == F.col("top"), F.col("alike")).otherwise(F.array("t.family")).alias("alike"), "t.family",
                    F.struct((-F.col("t.o")).alias("overlap"), (-F.col("t.p")).alias("probability"), F.col("t.template").alias("template")).alias("t"))).checkpoint()
    # such a line follows what other lines of its text say
    sure = kept.filter(F.size("alike") == 1).groupBy("k1", "k2").agg(F.collect_set("family").alias("sure"))       # families at most
    return (kept.join(sure, ["k1", "k2"], "left")
            .filter((F.size("alike") == 1) | F.col("sure").isNull() | ~F.arrays_overlap("alike", "sure"))
            .groupBy("k1", "k2", "para", "family").agg(F.max("t").alias("t"))
            .select("k1", "k2", "para", "family", "t.*"))


def notices(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``, confirmed ``paragraph`` (line number from 0) and
    ``family``: ``template``, ``overlap`` and ``probability``; none for unknown."""
    rows = hashed(df, id_col, text_col)
    found = confirmed(rows, model).checkpoint()      # few rows; cut off, so that the join can split a text of very many copies
    return (rows.select("id_", "k1", "k2").join(found, ["k1", "k2"])
            .select(F.col("id_").alias(id_col), F.col("para").alias("paragraph"), "family", "template", "overlap", "probability"))


def scan(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
         found: tuple[list[str], DataFrame] | None = None) -> DataFrame:
    """One row per row: the id, ``family`` (the closest, or unknown), its ``probability``,
    ``paragraph`` (line number from 0), ``template`` and ``overlap``;
    ``n_paragraphs`` (confirmed ones) and ``families`` (all of them, sorted)."""
    rows = hashed(df, id_col, text_col)
    per_row = confirmed(rows, model, found).groupBy("k1", "k2").agg(
        F.max(F.struct("overlap", "probability", (-F.col("para")).alias("neg"), "family", "template")).alias("b"),
        F.size(F.collect_set("para")).cast("long").alias("n_paragraphs"), F.sort_array(F.collect_set("family")).alias("families"))
    per_row = per_row.checkpoint()                   # cut off, so that the join can split a text of very many copies
    out = rows.select("id_", "k1", "k2").join(per_row, ["k1", "k2"], "left")
    return out.select(F.col("id_").alias(id_col), F.coalesce("b.family", F.lit(UNKNOWN)).alias("family"), F.col("b.probability").alias("probability"),
                      (-F.col("b.neg")).alias("paragraph"), F.col("b.template").alias("template"), F.col("b.overlap").alias("overlap"),
                      F.coalesce("n_paragraphs", F.lit(0).cast("long")).alias("n_paragraphs"),
                      F.coalesce("families", F.array().cast("array<string>")).alias("families"))


def op10_licences(spark, sf_dir: str) -> DataFrame:
    """Licence families of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    checkpoint_dir(spark)
    listed = numbered(spark, rows_of(spark, None))
    lines = looked_up(docs, "text", listed).checkpoint()          # each paragraph's n-grams once, for training and scan
    return scan(docs, train(docs, lines=lines), found=(listed, lines))
