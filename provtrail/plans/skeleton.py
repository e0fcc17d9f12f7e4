"""Plans that differ only in the names of their tables, parsed once.

A scheduled query that runs on the tables of each tenant gives one plan text per tenant. A text is cut
into its skeleton, in which numbered holes stand for the table names of its identifiers, and these names.
A skeleton is parsed like a plan, and the names are filled into what comes out of it, so the work on each
text is a few string operations, however many nodes and columns its plan has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from provtrail.session import materialize
from provtrail.sources.tables import small_side

# What stands in front of a table's name in a plan text, and what a hole begins and ends with.
BEFORE_NAME = '.TableIdentifier","table":"'
OPEN, CLOSE = "\ue000", "\ue001"


@dataclass
class Skeletons:
    """``members``: the key of each plan, its skeleton_id and names. ``plans``: each skeleton
    once, as a plan: plan_id (the skeleton's), plan_json, files."""

    members: DataFrame
    plans: DataFrame


def cut(plans: DataFrame) -> DataFrame:
    """Add ``skeleton``, ``names`` and ``_id`` (of the skeleton and files) to rows with a ``plan_json`` and ``files``.

    Equal names are one hole. A text stays whole, without names, if a name is more than letters, digits and underscores.
    """
    behind = F.slice("_pieces", F.lit(2), F.size("_pieces"))
    at = plans.withColumn("_pieces", F.split("plan_json", rf"\Q{BEFORE_NAME}\E"))
    at = at.withColumn("_behind", behind)
    at = at.withColumn("_names", F.transform("_behind", lambda p: F.substring_index(p, '"', 1)))
    at = at.withColumn("_distinct", F.array_distinct("_names"))
    at = at.withColumn("_holed", F.concat(F.get("_pieces", F.lit(0)), F.array_join(F.zip_with(
        "_behind", "_names", lambda p, n: F.concat(
            F.lit(BEFORE_NAME + OPEN), F.array_position(F.col("_distinct"), n).cast("string"), F.lit(CLOSE),
            F.substr(p, F.length(n) + 1))), "")))
    at = at.withColumn("_plain", F.coalesce(
        (F.size("_distinct") > 0) & F.forall("_distinct", lambda n: n.rlike(r"^[A-Za-z0-9_]+\z")), F.lit(False)))
    at = at.select(
        *plans.columns, F.when(F.col("_plain"), F.col("_holed")).otherwise(F.col("plan_json")).alias("skeleton"),
        F.when(F.col("_plain"), F.col("_distinct")).otherwise(F.array().cast("array<string>")).alias("names"))
    return at.withColumn("_id", F.md5(F.concat_ws("\u0001", F.size("names").cast("string"), "skeleton", F.to_json("files"))))


def _whole_id() -> Column:
    """The id of a text that stays whole: its skeleton and names are all that it consists of."""
    return F.md5(F.concat_ws("\u0001", F.col("_id"), F.array_join("names", ",")))


def _one_text_each(plans: DataFrame, key: list[str], members: DataFrame, label: str) -> DataFrame:
    """One text for each ``_id`` among ``members``, cut anew, with this as ``_wanted``; a key may have other texts too."""
    chosen = materialize(members.groupBy(F.col("_id").alias("_wanted")).agg(F.min(F.struct(*key)).alias("_k")), label)
    texts = plans.select(*key, "plan_json", "files").join(
        small_side(chosen.select("_wanted", *[F.col(f"_k.{k}").alias(k) for k in key])), key)
    # Written first: a comparison with what is cut would be made a key of the join, for which all texts are cut again.
    return cut(materialize(texts, f"{label}-chosen"))


def skeletons(
    plans: DataFrame, key: list[str], kept: DataFrame | None = None, canonical: Callable[[], Column] | None = None,
) -> Skeletons:
    """Skeletons of plans: ``key``, plan_json and files.

    Texts are read once, for one row of a digest and names each, and once more for one text a skeleton.
    A text stays whole if one of its names stands elsewhere in it too (of such names more than the identifier
    could depend), if it has marks of holes of its own, or a name in ``kept`` (one column). What stands elsewhere
    is the same for all texts of a skeleton, so names are looked for among its words and not in each text; only
    if texts stay whole, they are read a third time for one of each. ``canonical`` gives the id of a skeleton from
    its plan_json and files; otherwise each distinct one counts.
    """
    found = materialize(cut(plans.select(*key, "plan_json", "files")).select(*key, "_id", "names"), "plan-names")
    texts = materialize(_one_text_each(plans, key, found, "skeletons").filter("_id = _wanted").select(
        "_id", F.col("skeleton").alias("plan_json"), "files",
        # A name has no other characters than words have, so it stands within one of them.
        F.array_join(F.array_distinct(F.regexp_extract_all("skeleton", F.lit("[A-Za-z0-9_]+"), F.lit(0))), " ").alias("_words"),
        (F.size(F.split("skeleton", OPEN)) > F.size(F.split("skeleton", rf"\Q{BEFORE_NAME}\E"))).alias("_marked"),
    ).dropDuplicates(["_id"]), "skeleton-texts")
    stays = (F.size("names") > 0) & (F.col("_marked") | F.exists("names", lambda n: F.contains(F.col("_words"), n)))
    members = found.join(small_side(texts.select("_id", "_words", "_marked"), 16 << 20), "_id").select(
        *key, "_id", _whole_id().alias("_whole"), "names", stays.alias("_stays"))
    if kept is not None:
        named = found.select(_whole_id().alias("_whole"), F.explode("names").alias("_name")).join(
            small_side(kept.toDF("_name")), "_name", "left_semi").select("_whole", F.lit(True).alias("_kept")).distinct()
        members = members.join(small_side(named), "_whole", "left").withColumn(
            "_stays", F.col("_stays") | F.coalesce("_kept", F.lit(False)))
    members = materialize(members.select(
        *key, F.when(F.col("_stays"), F.col("_whole")).otherwise(F.col("_id")).alias("_id"),
        F.when(F.col("_stays"), F.array().cast("array<string>")).otherwise(F.col("names")).alias("names"), "_stays"), "plan-members")
    texts = texts.select("_id", "plan_json", "files")
    staying = members.filter("_stays")
    if not staying.isEmpty():
        whole = _one_text_each(plans, key, staying, "whole").filter(_whole_id() == F.col("_wanted")).select(
            F.col("_wanted").alias("_id"), "plan_json", "files").dropDuplicates(["_id"])
        used = members.filter("not _stays").select("_id").distinct()
        texts = materialize(texts.join(used, "_id", "left_semi").unionByName(whole), "skeleton-texts")
    members = members.drop("_stays")
    if canonical is None:
        return Skeletons(members.withColumnRenamed("_id", "skeleton_id"), texts.withColumnRenamed("_id", "plan_id"))
    ids = materialize(texts.select("_id", canonical().alias("plan_id")), "skeleton-ids")
    members = members.join(small_side(ids), "_id").select(*key, F.col("plan_id").alias("skeleton_id"), "names")
    return Skeletons(members, texts.join(small_side(ids), "_id").select(
        "plan_id", "plan_json", "files").dropDuplicates(["plan_id"]))


def filled(name: Column | str, names: Column | str = "names") -> Column:
    """A dataset's or view's name with the table name in place of its hole."""
    name, names = (F.col(c) if isinstance(c, str) else c for c in (name, names))
    hole = F.substring_index(F.substring_index(name, OPEN, -1), CLOSE, 1).cast("int")
    return F.when(F.contains(name, F.lit(OPEN)), F.concat(
        F.substring_index(name, OPEN, 1), F.get(names, hole - 1), F.substring_index(name, CLOSE, -1))).otherwise(name)


def filled_sources(fields: Column | str, names: Column | str = "names") -> Column:
    """Column sources with their datasets' names filled in, sorted again."""
    return F.sort_array(F.transform(fields, lambda s: F.struct(
        s["namespace"].alias("namespace"), filled(s["name"], names).alias("name"), s["field"].alias("field"))))
