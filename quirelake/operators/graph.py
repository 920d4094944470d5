"""Queries on a triples table ``(subject, predicate, object)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.common import durable


def match(triples: DataFrame, subject: str | None = None, predicate: str | None = None, object_: str | None = None) -> DataFrame:
    """The triples with the given terms; None matches any."""
    out = triples
    for name, term in (("subject", subject), ("predicate", predicate), ("object", object_)):
        if term is not None:
            out = out.where(F.col(name) == term)
    return out


def explore(triples: DataFrame, start: str, depth: int = 2) -> DataFrame:
    """``(node, distance)``: the nodes within ``depth`` steps along triples in either direction."""
    both = F.explode(F.array(F.struct(F.col("subject").alias("a"), F.col("object").alias("b")), F.struct(F.col("object").alias("a"), F.col("subject").alias("b")))).alias("e")
    # Written once, so that no step makes the edges and their distinct ends again.
    edges = durable(triples.select(both).select("e.a", "e.b").distinct())
    seen = triples.sparkSession.createDataFrame([(start, 0)], "node string, distance int")
    frontier = seen
    for step in range(1, depth + 1):
        reached = edges.join(frontier.select(F.col("node").alias("a")), "a").select(F.col("b").alias("node")).distinct()
        frontier = durable(reached.join(seen.select("node"), "node", "left_anti").withColumn("distance", F.lit(step)))
        seen = seen.unionByName(frontier)
        if frontier.limit(1).count() == 0:
            break
    return seen


def explored_triples(triples: DataFrame, start: str, depth: int = 2) -> DataFrame:
    """``(subject, predicate, object, distance)``: the triples between nodes that ``explore`` reaches, with the distance of the nearer end."""
    nodes = durable(explore(triples, start, depth))
    ends = triples.distinct().join(nodes.select(F.col("node").alias("subject"), F.col("distance").alias("a")), "subject").join(nodes.select(F.col("node").alias("object"), F.col("distance").alias("b")), "object")
    return ends.select("subject", "predicate", "object", F.least("a", "b").alias("distance"))


def entity_search(triples: DataFrame, query: str, kind: str | None = None, limit: int = 50) -> DataFrame:
    """``(entity, n_triples)``: subjects that contain the text, of a type if given, most triples first."""
    hits = triples.where(F.contains(F.lower("subject"), F.lit(query.lower())))
    if kind is not None:
        hits = hits.join(triples.where((F.col("predicate") == "rdf:type") & (F.col("object") == kind)).select("subject").distinct(), "subject", "left_semi")
    return hits.groupBy(F.col("subject").alias("entity")).agg(F.count("*").alias("n_triples")).orderBy(F.desc("n_triples"), "entity").limit(limit)


def statistics(triples: DataFrame) -> DataFrame:
    """One row: triples, different subjects, predicates and objects, mean triples a subject."""
    out = triples.agg(F.count("*").alias("n_triples"), F.countDistinct("subject").alias("n_subjects"), F.countDistinct("predicate").alias("n_predicates"), F.countDistinct("object").alias("n_objects"))
    return out.withColumn("triples_per_subject", F.round(F.coalesce(F.try_divide("n_triples", "n_subjects"), F.lit(0.0)), 6))


def top_terms(triples: DataFrame, k: int = 10) -> DataFrame:
    """``(kind, term, n)``: the ``k`` most frequent predicates and types of entities; ties by term."""
    predicates_ = triples.groupBy(F.col("predicate").alias("term")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k).select(F.lit("predicate").alias("kind"), "term", "n")
    types = triples.where(F.col("predicate") == "rdf:type").groupBy(F.col("object").alias("term")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k).select(F.lit("type").alias("kind"), "term", "n")
    return predicates_.unionByName(types)


def predicates(triples: DataFrame) -> DataFrame:
    return triples.groupBy("predicate").agg(F.count("*").alias("n"))


def relationships(triples: DataFrame) -> DataFrame:
    """``(predicate, domain, range, n)``: how often a predicate joins two types."""
    types = triples.where(F.col("predicate") == "rdf:type").select("subject", F.col("object").alias("kind")).distinct()
    rows = triples.where(F.col("predicate") != "rdf:type").join(types.select("subject", F.col("kind").alias("domain")), "subject")
    # Few objects are named by many triples: those of one predicate and domain are summed up before their types are joined.
    summed = rows.groupBy("predicate", "domain", "object").agg(F.count("*").alias("n"))
    typed = summed.join(types.select(F.col("subject").alias("object"), F.col("kind").alias("range")), "object")
    return typed.groupBy("predicate", "domain", "range").agg(F.sum("n").alias("n"))


def closure(parents: DataFrame) -> DataFrame:
    """``(name, ancestor)``: all ancestors of each class of ``(name, parent)``, itself included; also where classes stand in a circle.

    Each round joins the paths found so far with each other, so their length
    doubles until nothing is new.
    """
    names = parents.select("name").unionByName(parents.select(F.col("parent").alias("name"))).where("name IS NOT NULL").distinct()
    up = parents.where("name IS NOT NULL AND parent IS NOT NULL").select("name", F.col("parent").alias("ancestor"))
    reached = durable(names.select("name", F.col("name").alias("ancestor")).unionByName(up).distinct())
    size = reached.count()
    while True:
        further = reached.select(F.col("name").alias("ancestor"), F.col("ancestor").alias("further"))
        grown = durable(reached.join(further, "ancestor").select("name", F.col("further").alias("ancestor")).distinct())
        now = grown.count()
        if now == size:
            return grown
        reached, size = grown, now


def ontology_errors(triples: DataFrame, properties: DataFrame, parents: DataFrame) -> DataFrame:
    """``(subject, predicate, object, error)``: triples that break a property's ``domain`` or ``range``, or that no property allows.

    ``properties`` has ``name``, ``domain`` and ``range``, null for any. A node
    is of its types and of all classes above them; nodes without type break
    none.
    """
    above = closure(parents)
    types = triples.where(F.col("predicate") == "rdf:type").select(F.col("subject").alias("node"), F.col("object").alias("name")).distinct()
    kinds = durable(types.join(above, "name", "left").select("node", F.coalesce("ancestor", "name").alias("kind")).distinct())
    typed = kinds.select("node").distinct()
    rows = triples.where(F.col("predicate") != "rdf:type").join(properties.select(F.col("name").alias("predicate"), "domain", "range", F.lit(True).alias("known")), "predicate", "left")
    out = rows.where("known IS NULL").select("subject", "predicate", "object", F.lit("unknown property").alias("error"))
    for end, bound in (("subject", "domain"), ("object", "range")):
        asked = rows.where(F.col(bound).isNotNull()).join(typed.withColumnRenamed("node", end), end, "left_semi")
        wrong = asked.join(kinds.select(F.col("node").alias(end), F.col("kind").alias(bound)), [end, bound], "left_anti")
        out = out.unionByName(wrong.select("subject", "predicate", "object", F.lit(bound).alias("error")))
    return out


def valid_triples(triples: DataFrame, properties: DataFrame, least: float = 0.7, length: int = 3) -> DataFrame:
    """Triples sure enough, with terms long enough, whose predicate is a property of the ontology."""
    rows = triples.where((F.coalesce("confidence", F.lit(0.8)) >= least) & (F.length("subject") >= length) & (F.length("object") >= length))
    return rows.join(properties.select(F.col("name").alias("predicate")).distinct(), "predicate", "left_semi")
