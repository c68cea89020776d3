"""Personal data in texts: candidate spans, boosted trees over their features, calibrated selection.

Base rules find e-mail addresses, IP addresses, payment cards and phone numbers
and check them. Generators of high recall propose further spans, which may
overlap: numbers that a base rule lost because it ran on into their
neighbours, other groupings, phone numbers without a plus, disguised addresses.

Every span is described by a few features with few values: form of the span,
check, neighbouring characters and words. So all spans of a corpus collapse to
counts per combination of values, of which there are at most ``COMBINATIONS``,
and the boosted trees learn from all of them. Spans of the base rules are
their positive examples, proposals that fail their kind's check the negative
ones. On documents held out from learning, each kind gets the lowest score
above which enough of the labelled spans are positive; proposals that reach it
are added.

Built-in functions only. Positions come from splitting a text at a pattern: a
match begins after all pieces and matches before it. Repeated groups would
recurse once a character in the regular-expression engine, so joining signs
are first replaced by a sign of a character class: then runs are plain loops,
however long the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import prod

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asphalt.llm.columns import packed, unpacked
from asphalt.llm.folds import held_out
from asphalt.session import materialise

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
PRECISION = 0.98  # of the labelled held-out spans at or above a kind's score
LEAST_HELD = 20  # labelled held-out spans of a kind without which nothing is added
ITERATIONS, DEPTH, STEP = 20, 4, 0.2
CONTEXT = 40  # characters before a span that its features look at
BLOCK = 256  # of positions that are added up together

# Signs that stand for a joining dot, space or hyphen; such signs in a text are replaced before.
_DOT, _SPACE, _HYPHEN, _OTHER = "\x01", "\x02", "\x03", "\x04"
_SPAN = "array<struct<kind:int,start:int,end:int,value:string,left:string,right:string>>"

# How many values each feature has; a combination is numbered in this mixed base.
LEVELS = {"kind": 4, "valid": 2, "size": 7, "form": 6, "lead": 3, "before": 4, "after": 4, "cue": 3}
COMBINATIONS = prod(LEVELS.values())

_CUES = {
    EMAIL: "mail|contact|write to", IP: r"\bip\b|address|host|server|login",
    CARD: "card|visa|master|amex|credit|payment", PHONE: r"phone|\btel|call|mobile|\bfax\b|\bcell",
}
_MISLEADING = r"token|order|invoice|version|isbn|serial|\bsku\b|\bid\b|\bref\b|hash|\bkey\b"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is read: a one-element array hands it on."""
    return F.transform(F.array(value), use)[0]


def _starts(steps: Column) -> Column:
    """Running sums of an array, in blocks so that very many values don't add up from the first one each."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def of_blocks(s: Column) -> Column:
        last = F.floor((F.size(s) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: total(F.slice(s, b * BLOCK + 1, F.lit(BLOCK))))

    def sums(s: Column, blocks: Column) -> Column:
        def at(i: Column) -> Column:
            b = F.floor(i / BLOCK).cast("int")
            before = F.when(b > 0, total(F.slice(blocks, F.lit(1), b))).otherwise(0)
            return before + total(F.slice(s, b * BLOCK + 1, i - b * BLOCK + 1))

        return F.transform(F.sequence(F.lit(0), F.size(s) - 1), at)

    return _bound(steps, lambda s: _bound(of_blocks(s), lambda blocks: sums(s, blocks)))


def located(searched: Column, pattern: str, kind: int, where: Column) -> Column:
    """Matches of a pattern with their positions in code points, where ``where`` holds: array of spans."""
    def spans(s: Column) -> Column:
        pieces, found = s["pieces"], s["found"]
        steps = F.transform(found, lambda f, i: F.length(F.get(pieces, i)) + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0))
        return _bound(_starts(steps), lambda at: F.transform(found, lambda f, i: F.struct(
            F.lit(kind).alias("kind"), F.get(at, i).alias("start"), (F.get(at, i) + F.length(f)).alias("end"),
            f.alias("value"), F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("left"), F.left(F.get(pieces, i + 1), F.lit(1)).alias("right"))))

    none = F.array().cast(_SPAN)
    cut = F.struct(
        F.split(searched, pattern, -1).alias("pieces"), F.regexp_extract_all(searched, F.lit(pattern), F.lit(0)).alias("found"))
    each = _bound(cut, lambda s: F.when(F.size(s["found"]) > 0, spans(s)).otherwise(none))
    return F.when(where, each.cast(_SPAN)).otherwise(none)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Does the last digit check the others? For digits only, at least one."""
    def worth(i: Column) -> Column:
        d = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        doubled = d * 2
        return F.when(i % 2 == 0, d).otherwise(doubled - F.when(doubled > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _octets(value: Column) -> Column:
    """Is each of the parts a number up to 255?"""
    def small(part: Column) -> Column:
        return part.rlike("^0*[0-9]{1,3}$") & (F.right(part, F.lit(3)).cast("int") <= 255)

    return F.forall(F.split(value, r"\."), small)


def _count(value: Column) -> Column:
    return F.length(digits_of(value))


def _base(text: Column) -> Column:
    """Spans of the base rules that pass their checks."""
    marked = F.translate(text, _DOT + _SPACE + _HYPHEN, _OTHER * 3)
    dotted = F.regexp_replace(marked, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT)
    spaced = F.regexp_replace(F.regexp_replace(marked, "(?<=[0-9]) (?=[0-9])", _SPACE), "(?<=[0-9])-(?=[0-9])", _HYPHEN)
    # A run is tried from its first sign, or from where the last match ended: other starts would match alike.
    email = located(
        dotted, r"(?:\G|(?<![A-Za-z0-9._%+\u0001-]))[A-Za-z0-9._%+\u0001-]++@[A-Za-z0-9-]++\u0001[A-Za-z0-9\u0001-]++", EMAIL,
        F.contains(text, F.lit("@")))
    ip = located(text, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]"))
    card = located(spaced, r"[0-9][0-9\u0002\u0003]++", CARD, text.rlike("[0-9](?:[ -]?[0-9]){13}"))
    phone = located(text, r"\+[0-9][ ().0-9-]+[0-9]", PHONE, F.contains(text, F.lit("+")))
    return F.concat(
        _shown(email), F.filter(ip, lambda s: _octets(s["value"])),
        F.filter(_shown(card), lambda s: _count(s["value"]).between(14, 19) & F.when(_count(s["value"]).between(14, 19), luhn(digits_of(s["value"]))).otherwise(False)),
        F.filter(phone, lambda s: _count(s["value"]).between(10, 15)))


def _shown(spans: Column) -> Column:
    """Joining signs as they were in the text."""
    def plain(c: Column) -> Column:
        return F.translate(c, _DOT + _SPACE + _HYPHEN, ". -")

    return F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), plain(s["value"]).alias("value"),
        plain(s["left"]).alias("left"), plain(s["right"]).alias("right")))


_LOCAL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_OPEN, _CLOSE = r"\s{0,2}[\[({<]\s?", r"\s?[\])}>]\s{0,2}"
# Generators: kind, pattern, and what a text must have for the pattern to be tried. Every repetition is bounded.
GENERATORS = [
    (EMAIL, rf"(?i){_LOCAL}(?: ?@ ?|{_OPEN}(?:at|@){_CLOSE})[A-Za-z0-9-]{{1,63}}(?:(?:\.|{_OPEN}(?:dot|\.){_CLOSE})[A-Za-z0-9-]{{1,63}}){{0,8}}",
     r"(?i)@|[\[({<]\s?at\s?[\])}>]"),
    (EMAIL, rf"(?i){_LOCAL} at [A-Za-z0-9-]{{1,63}}(?: dot [A-Za-z0-9-]{{1,63}}){{1,4}}", "(?i) at [A-Za-z0-9-]{1,63} dot "),
    (IP, rf"(?<![0-9]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])", r"[0-9]\.[0-9]{1,3}\.[0-9]"),
    (IP, r"(?<![0-9])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9])", r"[0-9]\.[0-9]{1,4}\.[0-9]"),
    (CARD, "(?<![0-9])[0-9]{13,19}(?![0-9])", "[0-9]{13}"),
    (CARD, r"(?<![0-9])[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])", "[0-9]{4}[ .-][0-9]{4}[ .-][0-9]{4}[ .-]"),
    (CARD, r"(?<![0-9])[0-9]{4}([ .-])[0-9]{6}\1[0-9]{5}(?![0-9])", "[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{5}"),
    (PHONE, r"(?<![0-9A-Za-z])(?:\+|00)?[0-9]{1,3}[ .-]{0,2}\(?[0-9]{2,4}\)?[ .-]{0,2}[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
     r"[0-9]{2}\)?[ .-]{0,2}[0-9]{3,4}[ .-]?[0-9]{3}"),
    (PHONE, r"(?<![0-9A-Za-z])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"),
]


def _proposed(text: Column) -> Column:
    return F.concat(*[located(text, pattern, kind, text.rlike(need)) for kind, pattern, need in GENERATORS])


def _is(kind: Column, number: int) -> Column:
    return kind == number


def _plain_address(value: Column) -> Column:
    """A disguised address as it would be written plainly."""
    at = F.regexp_replace(value, rf"(?i){_OPEN}(?:at|@){_CLOSE}| at | ?@ ?", "@")
    return F.regexp_replace(at, rf"(?i){_OPEN}(?:dot|\.){_CLOSE}| dot ", ".")


def _valid(kind: Column, value: Column) -> Column:
    """The check of the span's kind; a card's and a phone's count of digits is part of it."""
    count = _count(value)
    address = _plain_address(value).rlike(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]{1,600}+$") & _plain_address(value).rlike(r"\.[A-Za-z]{2,24}$")
    return (
        F.when(_is(kind, EMAIL), address).when(_is(kind, IP), _octets(value))
        .when(_is(kind, CARD), F.when(count.between(14, 19), luhn(digits_of(value))).otherwise(False))
        .otherwise(count.between(10, 15)))


def _neighbour(sign: Column) -> Column:
    """0 for none or white space, 1 a letter, 2 a digit or a joining sign, 3 anything else."""
    return F.when((sign == "") | sign.rlike(r"^\s$"), 0).when(sign.rlike(r"^\p{L}$"), 1).when(sign.rlike(r"^[0-9._/+=:-]$"), 2).otherwise(3)


def _features(span: Column) -> dict[str, Column]:
    kind, value = span["kind"], span["value"]
    count = F.when(_is(kind, EMAIL), F.length(F.substring_index(_plain_address(value), "@", 1))).otherwise(_count(value))
    size = F.lit(0)
    for n, least in enumerate((4, 10, 12, 14, 16, 17), start=1):
        size = F.when(count >= least, n).otherwise(size)
    form = (
        F.when(_is(kind, EMAIL), F.when(_plain_address(value) != value, 5).otherwise(0)).when(value.rlike(r"[()]"), 4)
        .when(value.rlike(" ") & value.rlike("[.-]"), 5).when(value.rlike(" "), 1).when(value.rlike("-"), 2)
        .when(value.rlike(r"\."), 3).otherwise(0))
    cue = F.lit(0)
    words = F.lower(span["left"])
    cue = F.when(words.rlike(_MISLEADING), 2).otherwise(cue)
    for number, pattern in _CUES.items():
        cue = F.when(_is(kind, number) & words.rlike(pattern), 1).otherwise(cue)
    return {
        "kind": kind, "valid": _valid(kind, value).cast("int"), "size": size, "form": form,
        "lead": F.when(value.startswith("+"), 1).when(value.startswith("0"), 2).otherwise(0),
        "before": _neighbour(F.right(span["left"], F.lit(1))), "after": _neighbour(span["right"]), "cue": cue,
    }


def _number(features: dict[str, Column]) -> Column:
    """Number of a combination of feature values."""
    total = F.lit(0)
    for name, levels in LEVELS.items():
        total = total * levels + features[name]
    return total


def _values(number: Column) -> dict[str, Column]:
    """Feature values of a combination's number."""
    found, rest = {}, number
    for name, levels in reversed(LEVELS.items()):
        found[name] = rest % levels
        rest = F.floor(rest / levels).cast("int")
    return found


def _described(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), _number(_features(s)).alias("number")))


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Base and proposed spans of every row, kept: (id, key, spot, held_out, base, proposed).

    ``spot`` numbers the rows, ``key`` is a hash of the text. Texts are read once, here.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return materialise(rows.select(
        "id", F.xxhash64("text").alias("key"), F.monotonically_increasing_id().alias("spot"), held_out(F.col("id")).alias("held_out"),
        _described(_base(text)).alias("base"), _described(_proposed(text)).alias("proposed")))


def proposals(found: DataFrame) -> DataFrame:
    """All spans one by one, with ``label``: (spot, held_out, start, kind, end, number, base, label).

    Base spans have label 1. Proposals that overlap a base span are left out.
    Those that fail their check have label 0, the others none.
    """
    each = found.where((F.size("base") > 0) | (F.size("proposed") > 0)).select(
        "spot", "held_out", F.explode(F.concat(
            F.transform("base", lambda s: F.struct(s.alias("span"), F.lit(True).alias("base"))),
            F.transform("proposed", lambda s: F.struct(s.alias("span"), F.lit(False).alias("base"))))).alias("e"))
    each = each.select("spot", "held_out", "e.span.*", "e.base")
    # A window holds the spans of one row; generators may propose the same one.
    order = Window.partitionBy("spot").orderBy("start", F.desc("base"), "kind", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    covered = F.max(F.when(F.col("base"), F.col("end"))).over(before) > F.col("start")
    met = F.min(F.when(F.col("base"), F.col("start"))).over(after) < F.col("end")
    own = F.struct("start", "kind", "end")
    again = F.lag(own).over(order) == own
    left_out = [F.coalesce(c, F.lit(False)) for c in (covered, met, again)]
    free = each.withColumn("left_out", left_out[0] | left_out[1] | left_out[2])
    free = free.where(F.col("base") | ~F.col("left_out")).drop("left_out")
    label = F.when(F.col("base"), 1).when(_values(F.col("number"))["valid"] == 0, 0)
    return free.withColumn("label", label)


@dataclass(frozen=True)
class SpanModel:
    """Combinations whose spans are added: (number, score), at most ``COMBINATIONS`` rows."""

    chosen: DataFrame


def fit(spans: DataFrame, precision: float = PRECISION, iterations: int = ITERATIONS, seed: int = 13) -> SpanModel:
    """Boosted trees over counts per combination, and a score per kind on the held-out documents.

    Without spans of both labels to learn from nothing is chosen.
    """
    counts = materialise(spans.groupBy("number", "label", "held_out").agg(F.count("*").alias("n")))
    learnt = counts.where("NOT held_out AND label IS NOT NULL")
    described = VectorAssembler(inputCols=list(LEVELS), outputCol="features")

    def vectors(df: DataFrame) -> DataFrame:
        return described.transform(df.select("*", *[v.alias(n) for n, v in _values(F.col("number")).items()]))

    none = spans.sparkSession.createDataFrame([], "number int, score double")
    if learnt.agg(F.count_distinct("label")).first()[0] < 2:
        return SpanModel(none)
    trees = GBTClassifier(
        labelCol="label", weightCol="n", maxIter=iterations, maxDepth=DEPTH, stepSize=STEP, seed=seed, maxBins=32)
    # At most two rows a combination: one task holds them.
    rows = vectors(learnt.groupBy("number", "label").agg(F.sum("n").cast("double").alias("n"))).coalesce(1).persist()
    try:
        model = trees.fit(rows)
    finally:
        rows.unpersist()
    scored = model.transform(vectors(counts.select("number").distinct().coalesce(1)))
    scored = materialise(scored.select("number", "kind", vector_to_array("probability")[1].alias("score")))
    held = counts.where("held_out AND label IS NOT NULL").join(scored, "number")
    by_score = held.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("right"))
    # One row a kind and score: as many as combinations at most.
    down = Window.partitionBy("kind").orderBy(F.desc("score"))
    reached = by_score.select("kind", "score", F.sum("n").over(down).alias("n"), F.sum("right").over(down).alias("right"))
    bounds = reached.where((F.col("right") >= precision * F.col("n")) & (F.col("n") >= LEAST_HELD)).groupBy("kind").agg(
        F.min("score").alias("bound"))
    return SpanModel(materialise(scored.join(F.broadcast(bounds), "kind").where("score >= bound").select("number", "score")))


def added(spans: DataFrame, model: SpanModel) -> DataFrame:
    """Proposals that the model chooses, without those inside another one: (spot, start, kind, end, score)."""
    chosen = spans.where("NOT base").join(F.broadcast(model.chosen), "number")  # at most COMBINATIONS rows
    order = Window.partitionBy("spot").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.max("end").over(order) >= F.col("end"), F.lit(False))
    return chosen.select("spot", "start", "kind", "end", "score", inside.alias("inside")).where("NOT inside").drop("inside")


def _written(spans: Column) -> Column:
    """Spans as kind:start:end with a comma between, by start and then kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _bare(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))


def _spans(docs: DataFrame, id_column: str, text_column: str, precision: float) -> DataFrame:
    found = candidates(docs, id_column, text_column)
    spans = materialise(proposals(found))
    more = added(spans, fit(spans, precision)).groupBy("spot").agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("more"))  # of one row
    both = F.concat(_bare(F.col("base")), F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return found.join(more, "spot", "left").select(
        F.col("id").alias("doc_id"), "key", _bare(F.col("base")).alias("base"), F.array_sort(both).alias("spans"))


def personal_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", precision: float = PRECISION) -> DataFrame:
    """Spans of every row: (doc_id, base, spans), arrays of (start, kind, end) sorted by start and kind.

    Positions count code points from 0, the end exclusive; ``kind`` indexes
    ``KINDS``. Base spans always stay, added ones don't overlap them. A null
    text counts as empty; empty texts have no spans. Rows that share an id or a
    text each get their own. Very long texts are searched whole, and no pattern
    takes time that grows with the square of a text. Other columns are ignored. An
    empty table gives an empty result.
    """
    return _spans(docs, id_column, text_column, precision).drop("key")


def span_digests(docs: DataFrame, **options) -> DataFrame:
    """Counts and digests of ``personal_spans``: (doc_id, n_email, ..., base_sha256, spans); counts are of base spans."""
    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    return personal_spans(docs, **options).select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column, mask: Callable[[Column], Column] | None = None) -> Column:
    """A text with its spans replaced, by the name of their kind in brackets unless ``mask`` says otherwise.

    ``spans`` is sorted. A span that begins within the one before it is replaced from that one's end on.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    mask = mask or (lambda kind: F.get(names, kind))
    whole = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        gap = span["start"] - state["at"]
        kept = F.when(gap > 0, F.substring(whole, state["at"] + 1, gap)).otherwise("")
        shown = F.when(span["end"] > state["at"], F.concat(kept, mask(span["kind"]))).otherwise("")
        return F.struct(F.concat(state["done"], shown).alias("done"), F.greatest(state["at"], span["end"]).alias("at"))

    done = F.aggregate(spans, start, step)
    return F.transform(F.array(done), lambda d: F.concat(d["done"], F.substring(whole, d["at"] + 1, F.length(whole))))[0]


def redacted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", precision: float = PRECISION) -> DataFrame:
    """The rows with their text masked. Columns stay; a null text stays null, its spans are none.

    Rows are matched by id and text, so repeated rows are masked alike.
    """
    rows = docs.select(
        packed(docs).alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("key"))
    spans = _spans(docs, id_column, text_column, precision).groupBy("doc_id", "key").agg(F.any_value("spans").alias("spans"))
    joined = rows.alias("r").join(
        spans.alias("s"), F.col("r.id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.key") == F.col("s.key")))
    names = docs.columns
    text = F.when(F.col("r.text").isNotNull(), masked(F.col("r.text"), F.col("s.spans")))
    kept = joined.select("r.row", text.alias(text_column))
    return kept.select(*unpacked(names, "row", [text_column])).select(*names)
