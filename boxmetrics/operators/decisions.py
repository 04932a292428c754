"""Choosing among candidates, queues of what a person must look at, and recording what they decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxmetrics.functions import text as tx
from boxmetrics.operators import tables as tb

# Fixed values of the rules below.
LEAST_POPULARITY, LEAST_VOTES = 0.2, 5
LEAST_SHARE = 0.55
LOOKED_AT = 5
LEAST_PERSON = 0.4
SHORT_FILM = 40
DOUBTFUL = 0.75


def worth_trying(popularity: Column, votes: Column) -> Column:
    """Candidates that nobody knows or voted for are left out; what is not known counts as nothing."""
    return ~((F.coalesce(popularity, F.lit(0.0)) < LEAST_POPULARITY) & (F.coalesce(votes, F.lit(0)) < LEAST_VOTES))


def film_score(asked: Column, title: Column, original: Column, year: Column, released: Column, popularity: Column) -> Column:
    """Likeness of the better of both titles, more for a release within a year and a little for being known; 1 at most at each step."""
    like = lambda t: tx.token_overlap(tx.search_key(asked), tx.search_key(F.coalesce(t, F.lit(""))))
    base = F.greatest(like(title), like(original))
    near = F.coalesce(F.abs(released - year) <= 1, F.lit(False))
    timed = F.least(base + F.when(near, 0.1).otherwise(0.0), F.lit(1.0))
    return F.least(timed + F.least(F.coalesce(popularity, F.lit(0.0)) / 1000, F.lit(0.05)), F.lit(1.0))


def best_film(pairs: DataFrame, domestic: bool = False) -> DataFrame:
    """The best candidate of each query (query_id, id, score); a query whose best one is no domestic feature has none.

    ``pairs`` has query_id, asked, year, id, title, original_title, released,
    popularity, votes, language, countries, minutes. Of equal scores the more
    popular, then the smaller id. The next best is not tried.
    """
    score = film_score(*[F.col(c) for c in ("asked", "title", "original_title", "year", "released", "popularity")])
    tried = pairs.where(worth_trying(F.col("popularity"), F.col("votes"))).withColumn("score", score).where("score > 0")
    best = tb.best_row(tried, ["query_id"], [F.desc("score"), F.desc_nulls_last("popularity"), F.col("id")])
    if domestic:
        spoken = (F.coalesce("language", F.lit("")) == "es") | F.coalesce(F.array_contains("countries", "ES"), F.lit(False))
        minutes = F.coalesce("minutes", F.lit(0))
        best = best.where(spoken & ~((minutes > 0) & (minutes < SHORT_FILM)))
    return best.select("query_id", "id", "score")


def best_person(pairs: DataFrame, department: str) -> DataFrame:
    """The best of the first LOOKED_AT candidates of each query (query_id, id, score), none under LEAST_PERSON.

    ``pairs`` has query_id, asked, id, name, department, popularity. Those of the
    wanted department come first, then the popular ones.
    """
    order = [F.when(F.col("department") == department, 0).otherwise(1), F.desc_nulls_last("popularity"), F.col("id")]
    tried = pairs.withColumn("_n", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("_n") <= LOOKED_AT)
    known = F.least(F.coalesce("popularity", F.lit(0.0)) / 500, F.lit(0.05))
    scored = tried.withColumn("score", F.least(F.lit(1.0), tx.person_score(F.col("asked"), F.col("name")) + known))
    return tb.best_row(scored, ["query_id"], [F.desc("score"), F.col("_n")]).where(F.col("score") >= LEAST_PERSON).select("query_id", "id", "score")


def assign_results(results: DataFrame, titles: DataFrame, least: float = LEAST_SHARE) -> DataFrame:
    """Search results to the titles of their batch, in turn: (batch, title, id).

    ``results`` has batch, pos, id, text and ``titles`` batch, pos, title. A
    result takes the title left with the largest share of its words in the text,
    the first of equals, if that is ``least`` or it is the only title left and
    has any. A batch, what one search asked for, is a list of results; the titles
    left are carried along it.
    """
    # texts and titles are made comparable once each, before they meet
    words = F.filter(F.split(tx.person_words(F.col("title")), " "), lambda w: F.length(w) > 2)
    hay = results.where("id IS NOT NULL").select("batch", F.col("pos").alias("r"), "id", tx.person_words(F.col("text")).alias("hay"))
    pair = hay.join(titles.select("batch", F.col("pos").alias("t"), "title", words.alias("words")), "batch")
    share = tx.contained_share(F.col("words"), F.col("hay"))
    each = pair.groupBy("batch", "r", "id").agg(F.collect_list(F.struct(share.alias("share"), (-F.col("t")).alias("before"), "title")).alias("titles"))
    batches = each.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("r", "id", "titles"))).alias("results"))
    left = F.array_distinct(F.flatten(F.transform("results", lambda r: F.transform(r["titles"], lambda t: t["before"]))))
    kinds = {f.name: f.dataType.simpleString() for f in each.schema}
    none = F.array().cast(f"array<struct<title:string,id:{kinds['id']}>>")

    def taken(state: Column, result: Column) -> Column:
        fits = F.filter(result["titles"], lambda t: F.array_contains(state["left"], t["before"]) & (t["share"] > 0))
        best = F.array_max(fits)  # the largest share, then the first place
        ok = F.coalesce((best["share"] >= least) | ((F.size(state["left"]) == 1) & best.isNotNull()), F.lit(False))
        rest = F.filter(state["left"], lambda t: t != best["before"])
        found = F.concat(state["found"], F.array(F.struct(best["title"].alias("title"), result["id"].alias("id"))))
        return F.struct(F.when(ok, rest).otherwise(state["left"]).alias("left"), F.when(ok, found).otherwise(state["found"]).alias("found"))

    whole = F.aggregate("results", F.struct(left.alias("left"), none.alias("found")), taken)
    return batches.select("batch", F.inline(whole["found"]))


# ---------------------------------------------------------------- queues


def searched(df: DataFrame, column: str, query: str | None) -> DataFrame:
    """The rows whose ``column`` holds ``query`` in any case; without a query all."""
    return df if query is None else df.where(F.col(column).ilike(f"%{query}%"))


def chart_queue(annual: DataFrame, catalogue: DataFrame, limit: int = 25, query: str | None = None) -> DataFrame:
    """Chart titles (title, released, revenue, spectators) that no sheet has, neither as its chart title nor by key; largest first."""
    rows = searched(annual, "title", query).withColumn("key", tx.raw_key(F.col("title")))
    named = catalogue.select(F.col("chart_title").alias("title")).where("title IS NOT NULL")
    keyed = catalogue.select(tx.raw_key(F.col("title")).alias("key")).where("key IS NOT NULL")
    open_ = rows.join(named, "title", "left_anti").join(keyed, "key", "left_anti")
    sums = open_.groupBy("title", "key").agg(F.min("released").alias("released"), F.sum("revenue").alias("revenue"), F.sum("spectators").alias("spectators"), F.count("*").alias("rows"))
    return sums.orderBy(F.desc_nulls_last("revenue"), F.desc_nulls_last("released"), "title").limit(limit)


def people_queue(people: DataFrame, limit: int = 50, query: str | None = None) -> DataFrame:
    """People nobody has reviewed whose match is missing, has no photo or is doubtful; the unmatched first."""
    missing = F.col("person_id").isNull() | F.col("photo").isNull() | F.col("score").isNull() | (F.col("score") < DOUBTFUL)
    rows = searched(people, "name", query).where(~F.coalesce("reviewed", F.lit(False)) & missing)
    order = [F.when(F.col("person_id").isNull(), 0).otherwise(1), F.asc_nulls_first("score"), F.desc_nulls_last("popularity"), F.col("name")]
    return rows.orderBy(*order).limit(limit)


def grant_queue(grants: DataFrame, candidates: DataFrame, limit: int = 50, query: str | None = None) -> DataFrame:
    """Grants that are not matched, with the number of candidates and the best one; those to review first, then by amount."""
    best = candidates.where("id IS NOT NULL").groupBy("grant_id").agg(F.count("*").alias("n"), F.min_by(F.struct("id", "found"), F.struct("rank", -F.col("likeness"), "id")).alias("best"), F.max("likeness").alias("likeness"))
    rows = searched(grants, "title", query).where("status <> 'matched'").join(best, "grant_id", "left")
    out = rows.select("grant_id", "title", "year", "amount", "status", F.coalesce("n", F.lit(0)).alias("n"), F.col("best.id").alias("id"), F.col("best.found").alias("found"), "likeness")
    return out.orderBy(F.when(F.col("status") == "review", 0).otherwise(1), F.desc_nulls_last("amount"), F.desc("year"), "title", "grant_id").limit(limit)


def raw_queue(raw: DataFrame, matches: DataFrame, catalogue: DataFrame, limit: int = 50, query: str | None = None, hard_only: bool = True) -> DataFrame:
    """Raw rows without a match, with how many sheets have their key.

    Rows with just one are as good as settled and hidden, unless one searches.
    """
    rows = searched(raw.join(matches.select("id"), "id", "left_anti"), "title", query).withColumn("key", tx.raw_key(F.col("title")))
    sheets = catalogue.select(tx.raw_key(F.col("title")).alias("key"), F.col("sheet")).distinct().groupBy("key").agg(F.count_distinct("sheet").alias("n"), F.min("sheet").alias("sheet"))
    out = rows.join(sheets, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if hard_only and not query:
        out = out.where("n <> 1")
    return out.orderBy(F.desc("n"), F.desc_nulls_last("amount"), F.desc("year"), "id").limit(limit).drop("key")


def film_queue(catalogue: DataFrame, matches: DataFrame, limit: int = 50, query: str | None = None) -> DataFrame:
    """Sheets without a film of the service, the latest first."""
    rows = searched(catalogue, "title", query).join(matches.select("sheet"), "sheet", "left_anti")
    return rows.orderBy(F.desc_nulls_last("released"), F.desc_nulls_last("year"), "sheet").limit(limit)


def pending_details(catalogue: DataFrame, details: DataFrame, limit: int | None = None) -> DataFrame:
    """Sheets whose details are missing or lack a director, newest first."""
    rows = catalogue.join(details.where("director IS NOT NULL").select("sheet"), "sheet", "left_anti").orderBy(F.desc("sheet"))
    return rows if limit is None else rows.limit(limit)


def derived_ids(ids: DataFrame, known: DataFrame, suffix: str = "40") -> DataFrame:
    """(id, found): the id itself if it is known, else the id with the suffix if that is, else null."""
    tries = ids.select("id", F.posexplode(F.array(F.col("id").cast("string"), F.concat(F.col("id").cast("string"), F.lit(suffix)))).alias("n", "try"))
    hit = tries.join(known.select(F.col("id").cast("string").alias("try")).distinct(), "try").groupBy("id").agg(F.min_by("try", "n").alias("found"))
    return ids.select("id").join(hit, "id", "left")


# ---------------------------------------------------------------- decisions


def record_decisions(base: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """What people decided, taken into the table of matches (key, target, status, method, note).

    ``decisions`` has the key, ``action``, target, note and ``at``: "match" and
    "change" set the target by hand, "none" states that there is none, "review"
    reopens it, "clear" forgets what was known. Of several for a key the latest counts.
    """
    last = tb.best_row(decisions, [key], [F.desc("at"), F.col("action")])
    status = F.when(F.col("action").isin("match", "change"), "matched").when(F.col("action") == "none", "no_sheet").otherwise("review")
    new = last.where("action <> 'clear'").select(key, F.when(F.col("action").isin("match", "change"), F.col("target")).alias("target"), status.alias("status"), F.lit("manual").alias("method"), "note")
    return base.join(last.select(key), key, "left_anti").select(key, "target", "status", "method", "note").unionByName(new)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Rows that meet the condition get the values, computed from the row as it was; a null condition leaves a row as it is."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition go; a null condition keeps a row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def renamed_ids(df: DataFrame, key: str, changes: DataFrame) -> DataFrame:
    """Rows under a wrong id (``old``) get the right one (``new``); where that has a row of its own already, the wrong row goes.

    If several wrong ids become one, the smallest keeps its row.
    """
    rename = changes.select(F.col("old").alias(key), F.col("new").alias("_new"))
    rows = df.join(rename, key, "left")
    taken = df.select(F.col(key).alias("_new"), F.lit(True).alias("_taken")).join(rename.select(F.col(key).alias("_new")), "_new", "left_anti")
    rows = rows.join(taken, "_new", "left").where("_new IS NULL OR _taken IS NULL")
    target = F.coalesce("_new", key)
    return tb.best_row(rows.withColumn("_target", target), ["_target"], [F.col(key)]).withColumn(key, F.col("_target")).select(*df.columns)


def moved_period(df: DataFrame, condition: Column, days: int, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Rows loaded under a wrong period are moved by ``days``; a row that is there already under the right one stays and the moved one goes."""
    moved = df.where(condition).withColumns({c: F.date_add(c, days) for c in (start, end)})
    rest = df.where(~F.coalesce(condition, F.lit(False)))
    return rest.unionByName(moved.join(rest.select(*keys), keys, "left_anti"))


def merge_fields(base: DataFrame, updates: DataFrame, key: str, keep: tuple[str, ...] = (), union: tuple[str, ...] = (), fill: tuple[str, ...] = ()) -> DataFrame:
    """Upsert by column: ``keep`` leaves what is there, ``union`` joins arrays (sorted, none twice), ``fill`` takes the update unless it is null; all others are overwritten."""
    cols = [c for c in base.columns if c != key]
    u = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in cols])
    both = base.join(u, base[key] == u["_key"], "full")
    old, new = F.col(key).isNotNull(), F.col("_key").isNotNull()

    def merged(c: str) -> Column:
        a, b = F.col(c), F.col(f"_{c}")
        if c in union:
            none = F.array().cast(base.schema[c].dataType)
            return F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none)))
        if c in keep:
            return F.when(old, a).otherwise(b)
        if c in fill:
            return F.coalesce(b, a)
        return F.when(new, b).otherwise(a)

    return both.select(F.coalesce(key, "_key").alias(key), *[merged(c).alias(c) for c in cols])


def run_counts(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """One row of a run's numbers: new and known keys, and rows that failed (a null key)."""
    tagged = rows.join(known.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    bad = F.col(key).isNull()
    return tagged.agg(F.count_if(~bad & F.col("_known").isNull()).alias("new"), F.count_if(~bad & F.col("_known").isNotNull()).alias("known"), F.count_if(bad).alias("failed"))
