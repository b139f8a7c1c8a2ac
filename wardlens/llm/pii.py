"""Personal data by bootstrapped contextual extraction.

Four kinds of identifiers with a form of their own are found by pattern; they are the seeds.
Every run of tokens with digits or an at sign, however long, is an instance and the two words
before it a pattern; runs with nothing but blanks between them, as in lists, share the pattern
before the first. What a run has besides a seed is looked at by itself.
Patterns and instances make a graph over the whole corpus: a pattern scores by the share of
its occurrences that lead to well-scored instances, an instance by the scores of the
patterns that lead to it, seeds staying at 1 and others counting DAMPING times their score.
Rounds go on until no score changes by more than SETTLED; that they do not is an error. What
follows a pattern that scores high and was seen with several identifiers is personal data,
too, of the pattern's kind.

All of it is built-in functions. Patterns match in linear time: runs are taken whole, and
start where a run starts or the match before ended.

Cases: null text is the empty text. Positions are in code points. Equal rows (doc_id and
text) have equal results. Null doc_ids are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import add_running_total, free_name, stage

#: The kinds in their order, and what they look like.
KINDS = ["email", "ip", "card", "phone"]
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a form to be looked for.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: A token with a digit or at sign and all tokens with digits right behind it make a run, runs
#: with nothing but blanks between them a chain.
WORD = r"[^\x20\x09-\x0D0-9@]*+"
REST = r"[^\x20\x09-\x0D]*+"
FIRST = rf"(?<![^\x20\x09-\x0D]){WORD}[0-9@]{REST}"
RUN = rf"{FIRST}(?:\x20{WORD}[0-9]{REST})*+"
CHAIN = rf"{FIRST}(?:[\x20\x09-\x0D]++{WORD}[0-9@]{REST})*+"
#: The two words before a chain, in a text read backwards.
CONTEXT = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++(?:[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)?)"
#: What a score that is no seed's counts; the largest change of settled scores; rounds that
#: are enough for it by far, as each leaves at most DAMPING of what was missing.
DAMPING = 0.75
SETTLED = 0.001
MOST_ROUNDS = 60
#: A pattern extracts if it scores so high and led to so many different good instances.
SURE = 0.6
SUPPORT = 3
#: Digits an unseen identifier has at least, unless it has an at sign.
DIGITS = 4


def add_matches(df: DataFrame, text: str, form: str, need: str, to: str) -> DataFrame:
    """``df`` with ``to``: the matches of a form as structs of found, start, stop and before.

    The pieces between the matches tell where they are; ``before`` is the piece before.
    """
    found, gaps, steps, starts = (f"{to}_{k}" for k in ("found", "gaps", "steps", "starts"))
    there = F.col(text).rlike(need)
    none = F.array().cast("array<string>")
    df = df.withColumns(
        {
            found: F.when(there, F.regexp_extract_all(text, F.lit(form), F.lit(0))).otherwise(none),
            gaps: F.when(there, F.split(text, form, -1)).otherwise(none),
        }
    )
    sizes = F.transform(found, lambda x, i: (F.length(x) + F.length(F.get(F.col(gaps), i))).cast("long"))
    df = add_running_total(df.withColumn(steps, sizes), steps, starts)

    def match(x: Column, i: Column) -> Column:
        before = F.get(F.col(gaps), i)
        start = F.get(F.col(starts), i) + F.length(before)
        return F.struct(
            x.alias("found"),
            start.alias("start"),
            (start + F.length(x)).alias("stop"),
            before.alias("before"),
        )

    return df.withColumn(to, F.transform(found, match)).drop(found, gaps, steps, starts)


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, the digit sums add up to a ten."""

    def add(total: Column, pair: Column) -> Column:
        twice = pair["digit"].cast("int") * F.when(pair["place"] % 2 == 1, 2).otherwise(1)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    backwards = F.transform(
        F.split(F.reverse(digits), ""), lambda d, i: F.struct(d.alias("digit"), i.alias("place"))
    )
    return F.aggregate(F.filter(backwards, lambda p: p["digit"] != ""), F.lit(0), add) % 10 == 0


def is_valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = digits_of(found)
        return F.length(digits).between(13, 19) & passes_luhn(digits)
    if kind == "phone":
        return F.length(digits_of(found)).between(9, 15)
    return F.lit(True)


def add_base_spans(df: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` with ``to``: valid matches as structs of kind (place in KINDS), start, stop."""
    spans = []
    for place, kind in enumerate(KINDS):
        df = add_matches(df, text, FORMS[kind], NEEDS[kind], f"{to}_{kind}")
        spans.append(_valid_spans(f"{to}_{kind}", place, kind))
    made = [f"{to}_{kind}" for kind in KINDS]
    return df.withColumn(to, F.array_sort(F.concat(*spans))).drop(*made)


def _valid_spans(matches: str, place: int, kind: str) -> Column:
    good = F.filter(matches, lambda m: is_valid(kind, m["found"]))
    return F.transform(
        good,
        lambda m: F.struct(F.lit(place).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop")),
    )


def add_chains(df: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` with ``to``: structs of found, start and pattern of all chains with words before them."""
    raw = f"{to}_raw"
    df = add_matches(df, text, CHAIN, "[0-9@]", raw)

    def chain(m: Column) -> Column:
        context = F.reverse(F.regexp_extract(F.reverse(m["before"]), CONTEXT, 1))
        pattern = F.regexp_replace(F.lower(context), r"[\x20\x09-\x0D]++", " ")
        return F.struct(m["found"].alias("found"), m["start"].alias("start"), pattern.alias("pattern"))

    made = F.transform(raw, chain)
    return df.withColumn(to, F.filter(made, lambda c: c["pattern"] != "")).drop(raw)


def others(run: Column, spans: Column) -> Column:
    """Structs of found and start: the parts of a run whose tokens touch none of ``spans``."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
    ends = F.concat(ordered, F.array(F.struct(run["stop"].alias("start"), run["stop"].alias("stop"))))

    def part(s: Column, i: Column) -> Column:
        start = F.when(i == 0, run["start"]).otherwise(
            F.array_max(F.transform(F.slice(ordered, F.lit(1), i), lambda t: t["stop"]))
        )
        between = F.substring(
            run["found"], (start - run["start"]).cast("int") + 1, F.greatest(s["start"] - start, F.lit(0)).cast("int")
        )
        # What is left of tokens that touch a span is no token.
        front = F.when(i == 0, "").otherwise(F.regexp_extract(between, r"^[^\x20]++", 0))
        behind = F.when(i == F.size(ordered), "").otherwise(F.regexp_extract(between, r"(?<![^\x20])[^\x20]++$", 0))
        kept = F.substring(
            between, F.length(front) + 1, F.greatest(F.length(between) - F.length(front) - F.length(behind), F.lit(0))
        )
        return F.struct(kept.alias("found"), (start + F.length(front)).alias("start"))

    return F.transform(ends, part)


def candidates(rows: DataFrame, *names: str) -> DataFrame:
    """``names``, start, stop, pattern, instance, seed, fit and counts of all candidates.

    ``rows`` have chains and base spans. Every run has the pattern before its chain. ``seed``
    is the kind of a base span the run touches; what such a run has besides is a candidate of
    its own. ``fit`` tells whether it could be an identifier by itself. ``counts`` tells
    whether it is an occurrence of its pattern: a chain's first run is one, and any seed.
    """
    # Outer explodes: from others Spark would infer filters on the arrays, move them below all
    # that makes the arrays, and work out one row's arrays again and again.
    chains = rows.select(*names, "base", F.explode_outer("chains").alias("chain")).where("chain is not null")
    runs = add_matches(chains.withColumn("body", F.col("chain.found")), "body", RUN, "[0-9@]", "runs")
    runs = runs.select(
        *names, "base", F.col("chain.pattern").alias("pattern"), F.col("chain.start").alias("from"), F.posexplode_outer("runs").alias("place", "m")
    ).where("m is not null")
    start, stop = F.col("from") + F.col("m.start"), F.col("from") + F.col("m.stop")
    runs = runs.withColumn("run", F.struct(F.col("m.found").alias("found"), start.alias("start"), stop.alias("stop")))
    run = F.col("run")
    touching = F.filter("base", lambda s: (s["start"] < run["stop"]) & (s["stop"] > run["start"]))
    runs = runs.withColumn("touching", touching).drop("base", "m", "from")
    seed = F.get("touching", F.lit(0))["kind"]
    whole = F.array(
        F.struct(run["found"].alias("found"), run["start"].alias("start"), seed.alias("seed"), ((F.col("place") == 0) | seed.isNotNull()).alias("counts"))
    )
    rest = F.transform(
        others(run, F.col("touching")),
        lambda o: F.struct(o["found"].alias("found"), o["start"].alias("start"), F.lit(None).cast("int").alias("seed"), F.lit(False).alias("counts")),
    )
    parts = F.when(seed.isNull() | ~run["found"].contains(" "), whole).otherwise(F.concat(whole, rest))
    made = runs.select(*names, "pattern", F.explode_outer(parts).alias("c")).where("c is not null")
    core = F.regexp_replace("c.found", r"^[^A-Za-z0-9+(]++|[^A-Za-z0-9)]++$", "")
    made = made.withColumns(
        {"core": core, "start": F.col("c.start") + F.length(F.regexp_extract("c.found", r"^[^A-Za-z0-9+(]*+", 0))}
    )
    made = made.select(
        *names,
        "start",
        (F.col("start") + F.length("core")).alias("stop"),
        "pattern",
        F.xxhash64(F.lower("core")).alias("instance"),
        "c.seed",
        ((F.length(digits_of(F.col("core"))) >= DIGITS) | F.col("core").contains("@")).alias("fit"),
        "c.counts",
    )
    # What follows in a chain and cannot be an identifier says nothing.
    return made.where("counts or fit")


def row_key(docs: DataFrame) -> dict[str, Column]:
    """What tells rows of different id or text apart, without nulls."""
    return {
        "key_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "key_null": F.col("doc_id").isNull(),
        "key_text": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
    }


def rated(parts: DataFrame, weights: DataFrame) -> DataFrame:
    """pattern, kind, support, score and the old score, from what adds up to scores."""
    sums = parts.groupBy("pattern", "kind").agg(
        F.sum("good").alias("good"), F.sum("support").alias("support"), F.max("old").alias("old")
    )
    # Sums may differ in the last places from run to run; rounded scores do not.
    score = F.round(F.col("good") / F.col("weight"), 9)
    return sums.join(weights, "pattern").select("pattern", "kind", "support", "old", score.alias("score"))


def sure_patterns(candidates: DataFrame, keep, counts: Column | None = None) -> DataFrame:
    """pattern and kind of the patterns that extract, by settled scores.

    With n and own the occurrences of an instance behind a pattern, all and those that count,
    the scores solve: pattern = sum(own * instance) / (sum(own) + 1), instance = 1 for seeds
    and DAMPING * sum(n * pattern) / sum(n) for others, kind by kind. Candidates for which ``counts`` does not hold get scores, but patterns none from them.
    """
    counts = F.lit(True) if counts is None else counts
    edges = keep(
        candidates.groupBy("pattern", "instance").agg(
            F.count("*").alias("n"), F.sum(counts.cast("long")).alias("own"), F.min("seed").alias("seed")
        ),
        "edges",
    )
    seeds = keep(
        edges.where("seed is not null").groupBy("instance").agg(F.min("seed").alias("kind")), "seeds"
    )
    of_pattern = keep(edges.groupBy("pattern").agg(F.sum("own").alias("of")), "of-pattern")
    of_instance = keep(edges.groupBy("instance").agg(F.sum("n").alias("of")), "of-instance")
    seeded = edges.join(seeds, "instance").groupBy("pattern", "kind").agg(
        F.sum("own").cast("double").alias("good"), F.sum((F.col("own") > 0).cast("int")).alias("support")
    )
    open_ones = edges.join(seeds.select("instance"), "instance", "left_anti").join(of_instance, "instance")
    links = keep(open_ones.select("pattern", "instance", "own", (F.col("n") / F.col("of")).alias("part")), "links")
    # What a pattern gets back from its own instances is put on the other side of the equation.
    own = links.groupBy("pattern").agg((DAMPING * F.sum(F.col("own") * F.col("part"))).alias("back"))
    weights = of_pattern.join(own, "pattern", "left").select(
        "pattern", F.coalesce("back", F.lit(0.0)).alias("back"), (F.col("of") + 1 - F.coalesce("back", F.lit(0.0))).alias("weight")
    )
    weights = keep(weights, "weights")
    none = F.lit(0.0)
    base = keep(seeded.withColumn("old", none), "seeded")
    patterns = keep(rated(base, weights), "patterns-0")
    for step in range(1, MOST_ROUNDS + 1):
        scores = patterns.select("pattern", "kind", "score")
        given = links.join(scores, "pattern").groupBy("instance", "kind").agg(
            F.sum(F.col("part") * F.col("score")).alias("score")
        )
        got = links.where("own > 0").join(given, "instance").groupBy("pattern", "kind").agg(
            (DAMPING * F.sum(F.col("own") * F.col("score"))).alias("good"),
            F.sum((F.col("score") >= SURE).cast("int")).alias("support"),
        )
        before = scores.join(weights, "pattern").select(
            "pattern", "kind", (-F.col("back") * F.col("score")).alias("good"), F.lit(0).alias("support"), F.col("score").alias("old")
        )
        parts = base.unionByName(got.withColumn("old", none)).unionByName(before)
        patterns = keep(rated(parts, weights), f"patterns-{step}")
        change = patterns.agg(F.max(F.abs(F.col("score") - F.col("old")))).first()[0]
        if change is None or change <= SETTLED:
            break
    else:
        raise RuntimeError(f"scores of patterns still changed in round {MOST_ROUNDS}")
    best = F.max_by("kind", F.struct("score", -F.col("kind")))
    sure = patterns.where((F.col("score") >= SURE) & (F.col("support") >= SUPPORT))
    return keep(sure.groupBy("pattern").agg(best.alias("kind")), "sure")


def found_spans(docs: DataFrame, keep) -> DataFrame:
    """doc_id, the row key, base spans and added spans of every row of ``docs``."""
    key = row_key(docs)
    rows = docs.select("doc_id", *(c.alias(k) for k, c in key.items()), F.coalesce("text", F.lit("")).alias("body"))
    rows = add_chains(add_base_spans(rows, "body", "base"), "body", "chains")
    rows = keep(rows.drop("body"), "found")
    names = list(key)
    loose = keep(candidates(rows, *names), "candidates")
    sure = sure_patterns(loose, keep, F.col("counts"))
    added = loose.where("seed is null and fit").join(sure, "pattern")
    added = added.groupBy(*names).agg(
        F.array_sort(F.collect_set(F.struct("kind", "start", "stop"))).alias("added")
    )
    added = keep(added, "added")
    none = F.array().cast(added.schema["added"].dataType)
    joined = rows.drop("chains").join(added, names, "left")
    return joined.withColumn("added", F.coalesce("added", none))


def listed(spans: Column) -> Column:
    """Spans as kind:start:stop, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their checksum, and all spans of every document."""
    found = found_spans(docs, stage(docs.sparkSession).keep)
    counts = [
        F.size(F.array_remove(F.transform("base", lambda s: s["kind"] == F.lit(place)), False))
        .cast("long")
        .alias(f"n_{kind}")
        for place, kind in enumerate(KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def masked(text: Column, spans: str) -> Column:
    """The text with each span's kind in its place; ``spans`` are in order and apart."""
    marks = F.array(*(F.lit(f"<{kind.upper()}>") for kind in KINDS))
    pieces = F.transform(
        spans,
        lambda s, i: F.concat(
            F.substring(text, end_before(spans, i) + 1, (s["start"] - end_before(spans, i)).cast("int")),
            F.get(marks, s["kind"]),
        ),
    )
    last = F.substring(text, end_before(spans, F.size(spans)) + 1, F.length(text))
    return F.concat(F.array_join(pieces, ""), last)


def end_before(spans: str, i: Column) -> Column:
    return F.when(i > 0, F.get(F.col(spans), i - 1)["stop"]).otherwise(0).cast("int")


def mask(docs: DataFrame) -> DataFrame:
    """The documents with all found personal data replaced by its kind.

    Where base spans of different kinds overlap, they are masked together as the first one.
    """
    found = found_spans(docs, stage(docs.sparkSession).keep)
    names = {k: free_name(docs, k) for k in (*row_key(docs), "spans")}
    both = F.sort_array(
        F.transform(
            F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))
        )
    )
    # Overlapping spans become one: a span inside what is masked already only widens it.
    empty = F.array().cast("array<struct<start:bigint,stop:bigint,kind:int>>")
    merged = F.aggregate(
        both,
        empty,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] > s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["start"].alias("start"),
                        F.greatest(F.get(done, F.size(done) - 1)["stop"], s["stop"]).alias("stop"),
                        F.get(done, F.size(done) - 1)["kind"].alias("kind"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    spans = found.where(F.size("base") + F.size("added") > 0)
    spans = spans.select(*(F.col(k).alias(names[k]) for k in row_key(docs)), merged.alias(names["spans"]))
    # Equal rows have equal spans.
    spans = spans.dropDuplicates([names[k] for k in row_key(docs)])
    keyed = docs.withColumns({names[k]: c for k, c in row_key(docs).items()})
    joined = keyed.join(spans, [names[k] for k in row_key(docs)], "left")
    text = F.when(F.col(names["spans"]).isNull(), F.col("text")).otherwise(masked(F.col("text"), names["spans"]))
    columns = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns)

