"""Personal data by bootstrapped contextual extraction, by DataFrame operations only.

Four expressions find the base spans (e-mail, address, card, phone). They are the seeds. Every other token with
a digit is a candidate. An occurrence induces lexical patterns: the word before it, and for candidates the
letters the token begins with. Patterns and instances form a graph with the number of occurrences on its
edges. Seeds are believed fully, tokens too short to identify anybody not at all. A pattern's score is the
mean belief in its instances, by occurrences; only patterns with enough different believed instances count.
The belief in any other instance is the mean score of its patterns. An instance once believed stays so, and Spark
repeats the two steps until no further one is. Believed instances are identifiers, and their spans join the base
spans as kind ``other``. Numbers written in groups (``DE12 3456 7890``) are one candidate, and their groups none.

Leftmost non-overlapping matches come from one pair of expressions: the matches themselves and the texts
between them, whose lengths add up to the places. Sums along a text are taken in runs (``running``), so that the
work grows with the text, not with its square.

Defined results: null and empty texts have no spans (``base_sha256`` of the empty string, empty ``spans``).
Rows are judged alone but for the patterns; repeated rows and ids give repeated results, and null ids are
carried along. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatwright.llm.texts import bound, only, running, staged, unused

# Kinds in the order in which they are listed, and what finds them. Runs are possessive and
# begin where a run begins, so every text is read in linear time.
KINDS = ("email", "ip", "card", "phone")
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
# A text without such a sign can't hold the kind.
SIGNS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

OTHER = "other"
# Tokens with a digit; before them, three to nine short groups of capitals and digits, which are one identifier. One of
# the first two groups has a digit.
_GROUP = r"[A-Z0-9]{2,4}+"
GROUPED = rf"(?=[A-Z]{{0,4}}\x20?[A-Z]{{0,3}}[0-9]){_GROUP}(?:\x20{_GROUP}(?![^\x20\x09-\x0D])){{2,8}}+"
DIGIT_TOKEN = rf"(?<![^\x20\x09-\x0D])(?:{GROUPED}|[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+)"

# Bootstrapping: the score that counts as belief, and the different believed instances a pattern needs.
LEAST_SCORE = 0.5
LEAST_INSTANCES = 3
# Letters and digits below which a token is a plain number or name: evidence against its pattern.
LEAST_LENGTH = 8
# Letters a token must begin with to make them a pattern of their own.
LEAST_PREFIX = 3

_SPAN = "array<struct<start:bigint,end:bigint,kind:string,found:string,before:string>>"

# Characters of a text that are cut at once.
PIECE = 1024


def _last_word(text: Column) -> Column:
    return F.substring_index(F.rtrim(text), " ", -1)


def _blanked(text: Column) -> Column:
    """White space as blanks."""
    return F.translate(text, "\t\n\x0b\x0c\r", "     ")


def _word_before(pairs: Column, pair: Column, i: Column) -> Column:
    """The last word before a match, if white space parts them; it may be the last of the match before."""

    def of(gap: Column) -> Column:
        alone = (F.trim(gap) == "") & (i > 0)
        earlier = _last_word(_blanked(F.get(pairs, i - 1)["found"]))
        return F.when(gap.endswith(" "), F.when(alone, earlier).otherwise(_last_word(gap))).otherwise("")

    return bound(_blanked(pair["before"]), of)


def matches(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches with their places (code points) and the word before each."""
    # One text more than matches: the last pair has no match and is dropped again.
    both = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(f"({pattern})")),
        lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m).alias("size"), m.alias("found"), b.alias("before")),
    )

    def placed(pairs: Column) -> Column:
        sizes = F.transform(pairs, lambda x: (x["gap"] + x["size"]).cast("bigint"))
        before = running(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b)
        words = F.transform(pairs, lambda x, i: _word_before(pairs, x, i))
        return F.zip_with(
            F.arrays_zip(before.alias("place"), words.alias("word")),
            pairs,
            lambda a, x: F.struct(
                (a["place"] + x["gap"]).alias("start"),
                (a["place"] + x["gap"] + x["size"]).alias("end"),
                F.lit(kind).alias("kind"),
                x["found"].alias("found"),
                a["word"].alias("before"),
            ),
        )

    return bound(F.filter(both, lambda x: x["found"].isNotNull()), placed)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.reverse(F.regexp_extract_all(digits, F.lit("([0-9])")))
    total = F.aggregate(
        F.transform(
            figures,
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    return total % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return found.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        digits = _digits(found)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(found)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    held = F.filter(matches(text, PATTERNS[kind], kind), lambda s: _valid(kind, s["found"]))
    sign = SIGNS[kind]
    may = text.contains(sign) if sign else text.rlike("[0-9]")
    return F.when(may, held).otherwise(F.array().cast(_SPAN))


def marked(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``mark`` (the row's text by hash), ``base`` spans and ``tokens`` with a digit outside them."""
    text = F.coalesce("text", F.lit(""))
    found = only(docs, "doc_id", "text").select(
        "doc_id",
        F.xxhash64("doc_id", text).alias("mark"),
        F.concat(*[base_spans(text, kind) for kind in KINDS]).alias("base"),
        F.when(text.rlike("[0-9]"), matches(text, DIGIT_TOKEN, OTHER)).otherwise(F.lit(None).cast(_SPAN)).alias("tokens"),
    )
    return found.select(
        "doc_id", "mark", "base", F.coalesce(_outside(F.col("tokens"), F.col("base")), F.array().cast(_SPAN)).alias("tokens")
    )


def _outside(tokens: Column, base: Column) -> Column:
    """The tokens that overlap no base span."""
    most = F.lit(2**62)

    def kept(items: Column) -> Column:
        # In order of their starts: how far the base spans before an item reach, and where the next one begins.
        reach = running(F.transform(items, lambda x: F.when(x["token"] == 0, x["end"]).otherwise(F.lit(-1).cast("bigint"))),
                        F.lit(-1).cast("bigint"), lambda a, b: F.greatest(a, b))
        ahead = F.reverse(
            running(
                F.transform(F.reverse(items), lambda x: F.when(x["token"] == 0, x["start"]).otherwise(most)),
                most,
                lambda a, b: F.least(a, b),
            )
        )
        around = F.zip_with(
            items,
            F.arrays_zip(reach.alias("reach"), ahead.alias("ahead")),
            lambda x, r: F.struct(x.alias("x"), r.alias("r")),
        )
        clear = F.filter(
            around,
            lambda y: (y["x"]["token"] == 1) & (y["r"]["reach"] <= y["x"]["start"]) & (y["r"]["ahead"] >= y["x"]["end"]),
        )
        return F.transform(clear, lambda y: y["x"]["span"])

    def item(span: Column, token: int) -> Column:
        return F.struct(
            span["start"].alias("start"), F.lit(token).alias("token"), span["end"].alias("end"), span.alias("span")
        )

    items = F.array_sort(
        F.concat(F.transform(base, lambda s: item(s, 0)), F.transform(tokens, lambda t: item(t, 1)))
    )
    return F.when((F.size(base) == 0) | (F.size(tokens) == 0), tokens).otherwise(bound(items, kept))


def _graph(rows: DataFrame) -> DataFrame:
    """Edges ``pattern``, ``instance``, ``n`` and ``known`` (1 for seeds, 0 for plain numbers, else null)."""
    seen = rows.select(F.explode(F.concat("base", "tokens")).alias("s")).select("s.*")
    word = F.lower("before")
    prefix = F.lower(F.regexp_extract("found", rf"^[^\p{{L}}0-9]*(\p{{L}}{{{LEAST_PREFIX},}})", 1))
    size = F.length(F.regexp_replace("found", r"[^\p{L}0-9]", ""))
    known = F.when(F.col("kind") != OTHER, 1.0).when(size < LEAST_LENGTH, 0.0)
    patterns = F.array(
        F.when(word != "", F.concat(F.lit("after "), word)),
        F.when((F.col("kind") == OTHER) & (prefix != ""), F.concat(F.lit("begins "), prefix)),
    )
    return (
        seen.select(F.explode(patterns).alias("pattern"), F.col("found").alias("instance"), known.alias("known"))
        .filter("pattern is not null")
        .groupBy("pattern", "instance")
        .agg(F.count("*").alias("n"), F.max("known").alias("known"))
    )


def believed_instances(rows: DataFrame) -> DataFrame:
    """``instance``: tokens that are no seeds but stand in patterns of high score."""
    edges = staged(_graph(rows), "graph")
    seeds = edges.filter("known is not null").groupBy("instance").agg(F.max("known").alias("belief"))
    unseen = edges.filter("known is null")
    believed, n = None, 0
    while True:
        belief = seeds if believed is None else seeds.unionByName(believed)
        scores = (
            edges.join(belief, "instance")
            .groupBy("pattern")
            .agg(
                (F.sum(F.col("n") * F.col("belief")) / F.sum("n")).alias("score"),
                F.count_if(F.col("belief") >= LEAST_SCORE).alias("support"),
            )
            .filter(F.col("support") >= LEAST_INSTANCES)
        )
        found = (
            unseen.join(scores, "pattern")
            .groupBy("instance")
            .agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("belief"))
        )
        if believed is not None:
            # A belief once gained is not lost again, so the rounds come to an end.
            earlier = believed.select("instance", F.col("belief").alias("earlier"))
            found = found.join(earlier, "instance", "full").select(
                "instance",
                F.when(F.col("earlier") >= LEAST_SCORE, F.greatest("earlier", F.coalesce("belief", "earlier")))
                .otherwise(F.coalesce("belief", "earlier"))
                .alias("belief"),
            )
        believed = staged(found, "belief")
        more = believed.filter(F.col("belief") >= LEAST_SCORE).count()
        if more == n:
            return believed.filter(F.col("belief") >= LEAST_SCORE).select("instance")
        n = more


def further_spans(rows: DataFrame) -> DataFrame:
    """``mark_id``, ``mark`` and ``more``: spans of believed instances, one row per marked document that has some."""
    tokens = rows.select(F.col("doc_id").alias("mark_id"), "mark", F.explode("tokens").alias("s"))
    held = tokens.join(believed_instances(rows), F.col("s.found") == F.col("instance"))
    return held.groupBy("mark_id", "mark").agg(F.collect_set("s").alias("more"))


def _same_row(mark: str = "mark") -> Column:
    return F.col("d.doc_id").eqNullSafe(F.col("m.mark_id")) & (F.col(f"d.{mark}") == F.col("m.mark"))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    ranked = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(F.lit([*KINDS, OTHER]), s["kind"]).alias("rank"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
            ),
        )
    )
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts of base spans by kind, ``base_sha256`` and ``spans``, one row per row of ``docs``."""
    rows = staged(marked(docs), "marked")
    more = further_spans(rows)
    joined = rows.alias("d").join(more.alias("m"), _same_row(), "left")
    every = F.concat("d.base", F.coalesce("m.more", F.array().cast(_SPAN)))

    def count(kind: str) -> Column:
        return F.size(F.filter("d.base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return joined.select(
        "d.doc_id",
        *map(count, KINDS),
        F.sha2(_listed(F.col("d.base")).cast("binary"), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
    )


def _without_spans(text: Column, spans: Column) -> Column:
    """``text`` with every span (in order of their starts) replaced by its kind.

    The text is cut into pieces of PIECE characters first: to find a place in a long text, it is read from its start.
    """

    def part(pieces: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
        at = (start - first * PIECE + 1).cast("int")
        one = F.substr(F.get(pieces, first), at, (end - start).cast("int"))
        several = F.concat(
            F.substr(F.get(pieces, first), at),
            F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.substr(F.get(pieces, last), F.lit(1), (end - last * PIECE).cast("int")),
        )
        return F.when(end <= start, "").when(first == last, one).otherwise(several)

    def written(reached: Column) -> Column:
        def of(pieces: Column) -> Column:
            parts = F.zip_with(
                spans,
                reached,
                lambda s, place: F.when(s["start"] < place, "").otherwise(
                    F.concat(part(pieces, place, s["start"]), F.lit("<"), s["kind"], F.lit(">"))
                ),
            )
            last = F.greatest(F.array_max(reached), F.element_at(spans, -1)["end"])
            return F.concat(F.array_join(parts, ""), part(pieces, last, F.length(text).cast("bigint")))

        return bound(F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{PIECE}}})")), of)

    zero = F.lit(0).cast("bigint")
    return bound(running(F.transform(spans, lambda s: s["end"]), zero, lambda a, b: F.greatest(a, b)), written)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``n_chars`` follows the new text.

    Spans that touch or overlap become one, named by the first.
    """
    names = docs.columns
    rows = staged(marked(docs), "marked")
    more = further_spans(rows)
    spans = (
        rows.alias("d")
        .join(more.alias("m"), _same_row(), "left")
        .select(
            F.col("d.doc_id").alias("mark_id"),
            "d.mark",
            F.array_sort(F.concat("d.base", F.coalesce("m.more", F.array().cast(_SPAN)))).alias("spans"),
        )
        .filter(F.size("spans") > 0)
        .dropDuplicates(["mark_id", "mark"])
    )
    mark = unused(docs, "_mark")
    joined = (
        docs.withColumn(mark, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
        .alias("d")
        .join(spans.alias("m"), _same_row(mark), "left")
    )
    text = F.col("d.text")
    new_text = _without_spans(text, F.col("m.spans"))
    new = joined.select(
        *[F.col(f"d.`{c}`") for c in names if c != "text"],
        F.when(F.col("m.spans").isNotNull(), new_text).otherwise(text).alias("text"),
    )
    if "n_chars" in names:
        new = new.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return new.select(*[F.col(f"`{c}`") for c in names])
