"""Personal data by patterns and by bootstrapped contextual extraction. DataFrame functions only.

Fixed patterns give the base spans. They are also the seeds of a search for identifiers that
no pattern describes: the words left and right of a seed induce lexical patterns, each
scored by how often it surrounds known entities rather than other tokens. Tokens gain
confidence from the patterns around them and give it back, over some rounds. Tokens that end
with high confidence, next to a pattern that many different seeds support, become spans.

The graph counts distinct strings beside each context word, so neither many copies of a text nor
varied text behind one string make its scores higher.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.text import put_back, set_aside, whole
from shelfcast.sources.settled import settle

KINDS = ("email", "ip", "card", "phone")
# The patterns can be searched without trying a run of characters twice: runs are possessive
# and begin where no run is under way, or where the match before ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # Whole chains of 16 to 19 digits with single separators.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A token with a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
# Characters beside a span in which its context word is looked for.
CONTEXT = 48
ROUNDS = 3
# Different seed strings that a pattern needs, and the confidence that a token needs.
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.9
# Tokens shorter than this or with fewer digits are not identifiers.
MIN_LENGTH, MIN_DIGITS = 6, 4
HASH = "_text_hash"
SPAN = "array<struct<kind:int,start:int,end:int>>"


def located(text: Column, pattern: str) -> Column:
    """Matches in order: ``array<struct<start, end, value>>``, in code points.

    What lies between the matches, and the matches themselves, give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pieces = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("value"))
    nothing = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,value:string>>").alias("spans"),
    )

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        end = start + F.length(piece["value"])
        span = F.struct(start.alias("start"), end.alias("end"), piece["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate(pieces, nothing, step, lambda state: state["spans"])
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>")
    )


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(
            F.when(doubled > 9, doubled - 9).otherwise(doubled)
        )

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda part: (F.length(F.ltrim(part, F.lit("0"))) <= 3)
            & (F.coalesce(F.nullif(F.ltrim(part, F.lit("0")), F.lit("")).cast("int"), F.lit(0)) <= 255),
        )
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _context(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The words left and right of a span, in lower case; empty at the ends of the text."""
    before = F.substr(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT)))
    after = F.substr(text, end + 1, F.lit(CONTEXT))
    left = F.regexp_extract(before, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1)
    right = F.regexp_extract(after, r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)", 1)
    return F.lower(left), F.lower(right)


def _searched(docs: DataFrame) -> DataFrame:
    """``doc_id, _text_hash, base, seen``: base spans, and all strings with their contexts.

    ``seen`` has the base spans and the other tokens with a digit or an at sign.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias(HASH), whole(F.col("text")).alias("text"))

    def valid(kind: str) -> Column:
        matches = located(F.col("text"), PATTERNS[kind])
        return F.filter(matches, lambda s: _valid(kind, s["value"]))

    rows = rows.withColumns({f"_{kind}": valid(kind) for kind in KINDS})

    def marked(kind: str) -> Column:
        return F.transform(
            f"_{kind}",
            lambda s: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                s["value"].alias("value"),
            ),
        )

    rows = rows.withColumn("_base", F.concat(*[marked(kind) for kind in KINDS]))
    rows = rows.withColumn("_tokens", located(F.col("text"), TOKEN))
    others = F.filter(
        "_tokens",
        lambda t: ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])),
    )
    unmarked = F.transform(
        others,
        lambda t: F.struct(
            F.lit(-1).alias("kind"),
            t["start"].alias("start"),
            t["end"].alias("end"),
            t["value"].alias("value"),
        ),
    )

    def in_context(span: Column) -> Column:
        left, right = _context(F.col("text"), span["start"], span["end"])
        return F.struct(
            span["kind"].alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            span["value"].alias("value"),
            left.alias("left"),
            right.alias("right"),
        )

    base = F.transform("_base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    return rows.select(
        "doc_id",
        HASH,
        base.alias("base"),
        F.transform(F.concat("_base", unmarked), in_context).alias("seen"),
    )


def _score(kind: str, side: str) -> str:
    return f"_{kind}_{side}"


def _seeds(strings: DataFrame, side: str) -> DataFrame:
    """Different seeds of every kind beside each word on one side that has enough of one.

    A seed counts once beside a word, whatever stands on its other side.
    """
    seeds = strings.where((F.col("kind") >= 0) & (F.col(side) != ""))
    counts = [
        F.sum((F.col("kind") == number).cast("long")).alias(f"seeds_{kind}_{side}")
        for number, kind in enumerate(KINDS)
    ]
    counted = seeds.select(side, "kind", "value").distinct().groupBy(side).agg(*counts)
    return counted.where(F.greatest(*[f"seeds_{kind}_{side}" for kind in KINDS]) >= MIN_SEEDS)


def _patterns(others: DataFrame, seeds: DataFrame, side: str) -> DataFrame:
    """Score of every context word on one side, per kind.

    Known entities count whole, other tokens with their confidence so far, out of all
    different strings beside the word. Words with few different seeds of a kind have no score
    for it.
    """
    values = others.groupBy(side, "value").agg(*[F.max(kind).alias(kind) for kind in KINDS])
    beside = values.groupBy(side).agg(
        F.count("*").alias("_others"), *[F.sum(kind).alias(kind) for kind in KINDS]
    )
    known = [F.col(f"seeds_{kind}_{side}") for kind in KINDS]
    strings = F.coalesce("_others", F.lit(0)) + reduce(lambda a, b: a + b, known)
    scores = [
        F.when(seen >= MIN_SEEDS, (seen + F.coalesce(kind, F.lit(0.0))) / strings)
        .otherwise(0.0)
        .alias(_score(kind, side))
        for kind, seen in zip(KINDS, known)
    ]
    return seeds.join(beside, side, "left").select(side, *scores)


def confident_pairs(strings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Pairs of context words of unknown strings with a confidence per kind.

    ``strings`` has the distinct ``left, right, kind, value``; kind -1 is no known entity.
    Pairs of which neither word has enough seeds have no confidence and are left out.
    """
    seeds = {side: settle(_seeds(strings, side)) for side in ("left", "right")}
    others = strings.where("kind = -1").select("left", "right", "value")
    for side, words in seeds.items():
        others = others.join(words.select(side, F.lit(True).alias(f"_has_{side}")), side, "left")
    others = others.where("_has_left OR _has_right").select("left", "right", "value")
    others = settle(others.withColumns({kind: F.lit(0.0) for kind in KINDS}))
    columns = others.columns
    for _ in range(rounds):
        scored = others
        for side in ("left", "right"):
            scored = scored.join(_patterns(others, seeds[side], side), side, "left")
        confidence = {
            kind: 1
            - (1 - F.coalesce(_score(kind, "left"), F.lit(0.0)))
            * (1 - F.coalesce(_score(kind, "right"), F.lit(0.0)))
            for kind in KINDS
        }
        others = settle(scored.withColumns(confidence).select(*columns))
    return others.groupBy("left", "right").agg(*[F.max(kind).alias(kind) for kind in KINDS])


def _discovered(searched: DataFrame, threshold: float) -> DataFrame:
    """Spans of tokens that no base pattern describes: ``doc_id, _text_hash, more``."""
    seen = searched.select("doc_id", HASH, F.explode("seen").alias("s")).select("doc_id", HASH, "s.*")
    strings = seen.select("left", "right", "kind", "value").distinct()
    pairs = confident_pairs(strings)
    best = F.greatest(*KINDS)
    chosen = F.coalesce(
        *[F.when(F.col(kind) == best, F.lit(number)) for number, kind in enumerate(KINDS)]
    )
    trusted = pairs.where(best >= threshold).select(
        "left", "right", chosen.alias("kind")
    )
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    likely = ((digits >= MIN_DIGITS) | F.col("value").contains("@")) & (
        F.length("value") >= MIN_LENGTH
    )
    tokens = seen.where((F.col("kind") == -1) & likely).drop("kind")
    found = tokens.join(trusted, ["left", "right"])
    span = F.struct("kind", "start", "end")
    return found.groupBy("doc_id", HASH).agg(F.collect_set(span).alias("more"))


def personal_data(docs: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    """``doc_id, _text_hash, base, spans`` of every document.

    Both are arrays of ``kind`` (place in KINDS), ``start`` and ``end`` in code points, the
    end exclusive, by kind and start; ``spans`` has the base spans and the discovered ones.
    A NULL text counts as an empty one and has no spans; its hash is that of NULL. Rows that
    repeat an id are searched each in its own text; equal rows get equal spans. Other columns
    play no part. An empty table gives an empty result.
    """
    searched = settle(_searched(docs))
    more = _discovered(searched, threshold).select(
        F.col("doc_id").alias("_id"), F.col(HASH).alias("_hash"), "more"
    )
    same = searched["doc_id"].eqNullSafe(more["_id"]) & searched[HASH].eqNullSafe(more["_hash"])
    extra = F.coalesce("more", F.array().cast(SPAN))
    return searched.join(more, same, "left").select(
        "doc_id", HASH, "base", F.array_sort(F.concat("base", extra)).alias("spans")
    )


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; columns stay.

    ``n_chars``, if there, is counted anew. Of overlapping spans the first one is replaced
    and the rest of the others dropped. A NULL text stays NULL, an empty one empty, and long
    ones are searched as a whole. Repeated rows are changed alike and all stay. An empty table
    gives an empty result. Columns may have any name.
    """
    given, needed = docs, ("doc_id", "text", "n_chars")
    docs = set_aside(given, *needed)
    found = personal_data(docs.select("doc_id", "text"), threshold).where(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias("_id"), F.col(HASH).alias("_hash"), "spans")
    found = found.dropDuplicates(["_id", "_hash"])
    rows = docs.withColumn(HASH, F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(found["_id"]) & (rows[HASH] == found["_hash"])
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    by_place = F.array_sort(
        F.transform(
            "spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
    )
    text = F.col("text")

    def step(state: Column, span: Column) -> Column:
        between = F.substr(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        mark = F.when(span["start"] >= state["at"], F.get(names, span["kind"])).otherwise("")
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["out"], between, mark).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1, F.length(text)))
    clean = F.aggregate(by_place, begin, step, rest)
    joined = rows.join(found, same, "left")
    out = joined.withColumn("text", F.when(F.col("spans").isNull(), text).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return put_back(out, given, *needed)
