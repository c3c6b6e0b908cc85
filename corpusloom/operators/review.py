"""Review of corrections: which pulls count, which claims hold, what has been decided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import source_key
from ..functions.text import filled

#: Branches that corrections may target; the grammar of commands and markers.
BASES = ("main", "config", "ocr_config", "ocr_patch", "origin")
COMMAND = r"(?i)\A\s*/ocr-(keep|drop)\s+(all|\d+(?:[\s,]+\d+)*)\s*\z"
APPROVE, REJECT = r"(?i)\A\s*/proofread-approve\s*\z", r"(?i)\A\s*/proofread-reject\b.*\z"
REVERT_COMMAND = r"(?i)\A\s*/proofread-revert\s*\z"
REVERT = r"\Arevert-([0-9]+)-"


def proofreading_pulls(pulls: DataFrame) -> DataFrame:
    """Merged pulls of correction or revert branches of their own repository, with ``reverts`` (the number taken back) and ``key``.

    ``pulls``: repo, number, merged_at, head_ref, head_repo, base_ref.
    """
    reverts = F.expr("try_cast(nullif(regexp_extract(head_ref, r'^revert-([0-9]+)-', 1), '') as bigint)")
    kept = F.startswith("head_ref", F.lit("proofread/")) | F.col("head_ref").rlike(REVERT)
    return pulls.where(
        F.col("merged_at").isNotNull() & (F.col("head_repo") == F.col("repo")) & kept & F.col("base_ref").isin(*BASES)
    ).withColumns({"reverts": reverts, "key": source_key(F.col("repo"), F.col("number"))})


def candidates(pulls: DataFrame, known: DataFrame) -> DataFrame:
    """Pulls whose key isn't known (key)."""
    return pulls.join(known.select("key").distinct(), "key", "left_anti")


def settle_reverts(found: DataFrame, pulls: DataFrame, published: DataFrame) -> DataFrame:
    """Add ``kept``: a revert is kept only if its original was published or claimed (key); an original that a merged revert took back isn't."""
    undone = pulls.where("reverts is not null").select(source_key(F.col("repo"), F.col("reverts")).alias("key")).distinct().withColumn("__undone", F.lit(True))
    public = published.select(F.col("key").alias("__original")).distinct()
    joined = found.join(undone, "key", "left").withColumn("__of", source_key(F.col("repo"), F.col("reverts")))
    joined = joined.join(public, F.col("__of") == F.col("__original"), "left")
    kept = F.when(F.col("reverts").isNotNull(), F.col("__original").isNotNull()).otherwise(F.col("__undone").isNull())
    return joined.withColumn("kept", kept).drop("__undone", "__of", "__original")


def publish_groups(found: DataFrame, order: str = "number") -> DataFrame:
    """Candidates by repository and base, their numbers in order (of ``number``, or of another column such as ``merged_at``)."""
    placed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col("number").alias("number"))))
    return found.groupBy("repo", "base_ref").agg(F.transform(placed, lambda x: x["number"]).alias("numbers"))


def authorized(actor: Column, allowed: list[str], permission: Column) -> Column:
    """Whether an actor may decide: one of the allowed, or, where none are named, one whose permission is high enough."""
    return actor.isin(*allowed) if allowed else F.coalesce(permission.isin("admin", "maintain", "push"), F.lit(False))


def compact_conflict(conflict: Column) -> Column:
    """What is kept of a conflict: its archive, the revisions on both sides, and its articles' paths and ids."""
    return F.struct(
        *(conflict[c].alias(c) for c in ("archive_id", "repository", "old_ocr_cache", "new_ocr_cache", "mirror_ocr_patch", "upstream_ocr_patch")),
        F.transform(
            F.coalesce(conflict["articles"], F.array()), lambda a: F.struct(*(a[c].alias(c) for c in ("path", "article_id", "publication_id", "doc_id")))
        ).alias("articles"),
    )


def refreshed_claims(claims: DataFrame, pulls: DataFrame) -> DataFrame:
    """The outcome of each claim (key, repo, number, repository) by the state of its pull (repo, number, merged, state).

    ``published`` when merged, ``claimed`` while open, ``released`` when it is closed, gone,
    without a number or points to another repository.
    """
    states = pulls.select("repo", "number", "merged", "state").distinct()
    joined = claims.join(states, ["repo", "number"], "left")
    outcome = (
        F.when(F.col("number").isNull() | (F.col("repository") != F.col("repo")), "released")
        .when(F.coalesce("merged", F.lit(False)), "published")
        .when(F.col("state") == "open", "claimed")
        .otherwise("released")
    )
    return joined.withColumn("outcome", outcome)


def claim_repository(repository: Column, url: Column) -> Column:
    """A claim's repository: its own field, else from the URL of its pull."""
    return filled(repository, F.nullif(F.regexp_extract(url, r"^https?://[^/]+/([^/]+/[^/]+)/pull/\d+", 1), F.lit("")))


def decided(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last decision of each key, except that a drop is final; ``restored`` counts keeps after it, which are errors."""
    place = F.struct(*order)
    dropped = F.min(F.when(F.col("action") == "drop", place))
    grouped = events.groupBy(*keys).agg(dropped.alias("__drop"), F.max_by("action", place).alias("__last"), F.collect_list(F.when(F.col("action") == "keep", place)).alias("__keeps"))
    return grouped.select(
        *keys,
        F.when(F.col("__drop").isNotNull(), "drop").otherwise(F.col("__last")).alias("action"),
        F.size(F.filter("__keeps", lambda p: p > F.col("__drop"))).cast("bigint").alias("restored"),
    )


def completeness(items: DataFrame, decisions: DataFrame, group: list[str], keys: list[str]) -> DataFrame:
    """For each group of items: how many are decided, and whether all are."""
    joined = items.join(decisions.select(*keys, "action"), keys, "left")
    done = F.coalesce(F.col("action").isin("keep", "drop"), F.lit(False))
    return joined.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.count_if(done).alias("n_decided"), F.bool_and(done).alias("complete"))


def resolved(merged: Column, state: Column) -> Column:
    return F.coalesce(merged, F.lit(False)) | F.coalesce(state == "closed", F.lit(False))


def all_resolved(links: DataFrame, pulls: DataFrame, by: list[str], on: list[str]) -> DataFrame:
    """For each issue whether it links pulls and all of them are resolved."""
    joined = links.join(pulls.withColumn("__r", resolved(F.col("merged"), F.col("state"))), on, "left")
    done = F.coalesce("__r", F.lit(False))
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("n_pulls"), F.bool_and(done).alias("all_resolved"))


def command(body: Column, n: Column) -> Column:
    """The action and the places (1 to n, in order, once each) of a review command; null when it is none or a place is out of range."""
    action = F.lower(F.regexp_extract(body, COMMAND, 1))
    raw = F.lower(F.regexp_extract(body, COMMAND, 2))
    listed = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(raw, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("int"))))
    every = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    places = F.when(raw == "all", every).otherwise(listed)
    good = (action != "") & (F.size(places) > 0) & F.forall(places, lambda i: (i >= 1) & (i <= n))
    return F.when(good, F.struct(action.alias("action"), places.alias("places")))


def linked_pulls(body: Column, marker: str = "proofreading-prs") -> Column:
    """The pulls listed in the JSON of a body's marker."""
    kind = "array<struct<repo:string,number:bigint,url:string>>"
    return F.coalesce(F.from_json(F.regexp_extract(body, rf"(?s)<!--\s*{marker}:(.*?)\s*-->", 1), kind), F.array().cast(kind))


def marker_issue(issues: DataFrame, marker: str, kind: str, key: str) -> DataFrame:
    """Issues with the value of ``key`` in their marker; the last issue of each value counts."""
    found = issues.withColumn("__m", F.from_json(F.regexp_extract("body", rf"(?s)<!--\s*{marker}:(.*?)\s*-->", 1), kind))
    return found.where(F.col(f"__m.{key}").isNotNull()).groupBy(F.col(f"__m.{key}").alias(key)).agg(F.max_by("issue", "position").alias("issue"))


def first_tracker(issues: DataFrame, marker: str = "proofreading-prs") -> DataFrame:
    """(repo, number) of every linked pull with the first issue that lists it."""
    links = issues.select("issue", "position", F.explode(linked_pulls(F.col("body"), marker)).alias("p"))
    return links.groupBy("p.repo", "p.number").agg(F.min_by("issue", "position").alias("issue"))


def existing_reverts(pulls: DataFrame, numbers: DataFrame) -> DataFrame:
    """For each number the first pull that mentions ``#number`` and speaks of a revert.

    Mentions are extracted first, so this is an equality join; a mention of #12 also
    counts as one of #1, so every beginning of its digits is a key.
    """
    digits = F.explode(F.regexp_extract_all("body", F.lit(r"#(\d+)"), F.lit(1))).alias("digits")
    said = pulls.where(F.contains(F.lower("title"), F.lit("revert"))).select("pull", "position", digits)
    prefixes = F.transform(F.sequence(F.lit(1), F.length("digits")), lambda n: F.left(F.col("digits"), n))
    keys = said.select("pull", "position", F.explode(prefixes).alias("number")).distinct()
    first = keys.groupBy("number").agg(F.min_by("pull", "position").alias("pull"))
    return numbers.select(F.col("number").cast("string").alias("number")).join(first, "number", "left")


def newest(df: DataFrame, by: list[str], position: str) -> DataFrame:
    """The row of each group that stands first in a listing of newest first."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.min_by(F.struct(*rest), position).alias("__first")).select(*by, "__first.*")


def section(body: Column, heading: str) -> Column:
    """The text between a second-level heading and the next one; null without it."""
    found = F.regexp_extract(body, rf"(?s)(?:\A|\n)## {heading}\s*\n(.*?)(?=\n## |\z)", 1)
    return F.when(body.rlike(rf"(?:\A|\n)## {heading}"), F.btrim(found, F.lit("\n ")))


def missing_markers(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Comments (marker, body and others) whose marker hasn't been posted: appending them twice does nothing.

    Of several with one marker the smallest counts, column by column from the left.
    """
    rest = [c for c in wanted.columns if c != "marker"]
    once = wanted.groupBy("marker").agg(F.min(F.struct(*rest)).alias("__c")).select("marker", "__c.*") if rest else wanted.distinct()
    return once.join(existing.select("marker"), "marker", "left_anti")


def change_summary(parts: Column, comments: Column, description: Column, fields: Column) -> Column:
    """One line for each kind of change, with the number of changed paragraphs."""
    lines = F.concat(
        F.when(parts > 0, F.array(F.concat(F.lit("正文段落 "), parts.cast("string"), F.lit(" 处")))).otherwise(F.array().cast("array<string>")),
        F.when(comments > 0, F.array(F.lit("注释"))).otherwise(F.array().cast("array<string>")),
        F.when(description, F.array(F.lit("描述"))).otherwise(F.array().cast("array<string>")),
        F.coalesce(fields, F.array().cast("array<string>")),
    )
    return F.when(F.size(lines) > 0, lines).otherwise(F.array(F.lit("校订")))


def unmanaged(mirror: DataFrame, upstream: DataFrame, managed: DataFrame, on: list[str]) -> DataFrame:
    """Branches that the mirror inherited and nobody manages: in both, but not managed."""
    return mirror.select(*on).intersect(upstream.select(*on)).exceptAll(managed.select(*on).distinct())


def only_in(mirror: DataFrame, upstream: DataFrame, on: list[str]) -> DataFrame:
    """Branches of the mirror alone."""
    return mirror.select(*on).subtract(upstream.select(*on))


def verdict(body: Column) -> Column:
    """approve, reject or revert, by the command a comment is; null for others."""
    kinds = ((APPROVE, "approve"), (REJECT, "reject"), (REVERT_COMMAND, "revert"))
    return F.coalesce(*(F.when(body.rlike("(?s)" + pattern), name) for pattern, name in kinds))


def closed_temporaries(branches: DataFrame, pulls: DataFrame, on: list[str], pattern: str) -> DataFrame:
    """Temporary branches that have pulls, all of them closed."""
    own = branches.where(F.col("branch").rlike(pattern))
    state = pulls.groupBy(*on).agg(F.bool_and(F.col("state") == "closed").alias("__closed"))
    return own.join(state, on).where("__closed").drop("__closed")


def issues_to_close(issues: DataFrame, selected: list[int] | None, marker: str = "conflict") -> DataFrame:
    """Open issues whose marker names one of the selected archives; None selects all."""
    own = F.from_json(F.regexp_extract("body", rf"(?s)<!--\s*{marker}:(.*?)\s*-->", 1), "struct<archive_id:int>")["archive_id"]
    found = issues.where("state = 'open'").withColumn("archive_id", own).where("archive_id is not null")
    return found if selected is None else found.where(F.col("archive_id").isin(*selected))


def without_archive(path: Column) -> Column:
    """A path without its archive folder."""
    return F.regexp_replace(path, r"\Aarchives\d+/", "")


def input_snapshot(revisions: DataFrame, helper: str, layout: str = "2") -> DataFrame:
    """What a build depends on: the four input branches, the helper's revision and the patch layout."""
    return revisions.select("archive_id", "main", "config", "ocr_cache", "ocr_patch", F.lit(helper).alias("helper"), F.lit(layout).alias("patch_layout"))


def size_error(size: Column, most: int) -> Column:
    """Why a file's size can't be, or null."""
    return F.when(size.isNull() | (size <= 0), "empty").when(size > most, "too large")
