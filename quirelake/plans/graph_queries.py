"""Queries on the graph of triples and on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.operators import graph, sparql, tables, vectors
from quirelake.plans.registry import Registry

registry = Registry()
query = registry.add

TRIPLES = """WITH triples AS (
  SELECT 'region_' || r_regionkey AS subject, 'rdf:type' AS predicate, 'Region' AS object FROM region UNION ALL SELECT 'region_' || r_regionkey, 'name', r_name FROM region
  UNION ALL SELECT 'nation_' || n_nationkey, 'rdf:type', 'Nation' FROM nation UNION ALL SELECT 'nation_' || n_nationkey, 'name', n_name FROM nation UNION ALL SELECT 'nation_' || n_nationkey, 'locatedIn', 'region_' || n_regionkey FROM nation
  UNION ALL SELECT 'supplier_' || s_suppkey, 'rdf:type', 'Supplier' FROM supplier UNION ALL SELECT 'supplier_' || s_suppkey, 'basedIn', 'nation_' || s_nationkey FROM supplier
  UNION ALL SELECT 'customer_' || c_custkey, 'rdf:type', 'Customer' FROM customer UNION ALL SELECT 'customer_' || c_custkey, 'basedIn', 'nation_' || c_nationkey FROM customer)
"""


def _name(kind: str, key: str):
    return F.concat(F.lit(f"{kind}_"), F.col(key).cast("string"))


def triples(spark: SparkSession, d: str) -> DataFrame:
    parts = (
        ("region", _name("region", "r_regionkey"), {"rdf:type": F.lit("Region"), "name": F.col("r_name")}),
        ("nation", _name("nation", "n_nationkey"), {"rdf:type": F.lit("Nation"), "name": F.col("n_name"), "locatedIn": _name("region", "n_regionkey")}),
        ("supplier", _name("supplier", "s_suppkey"), {"rdf:type": F.lit("Supplier"), "basedIn": _name("nation", "s_nationkey")}),
        ("customer", _name("customer", "c_custkey"), {"rdf:type": F.lit("Customer"), "basedIn": _name("nation", "c_nationkey")}),
    )
    out = None
    for name, subject, columns in parts:
        rows = tables.row_triples(table(spark, d, name), subject, columns)
        out = rows if out is None else out.unionByName(rows)
    return out


@query(TRIPLES + "SELECT * FROM triples")
def row_triples(spark: SparkSession, d: str) -> DataFrame:
    return triples(spark, d)


@query(TRIPLES + """SELECT '<' || subject || '> <' || predicate || '> "' || replace(replace(object, '\\', '\\\\'), '"', '\\"') || '" .' AS line FROM triples""")
def ntriples_export(spark: SparkSession, d: str) -> DataFrame:
    return tables.n_triples(triples(spark, d))


@query(TRIPLES + "SELECT subject, subject || chr(10) || string_agg('    ' || predicate || ' ' || object, ' ;' || chr(10) ORDER BY predicate, object) || ' .' AS block FROM triples GROUP BY subject")
def turtle_export(spark: SparkSession, d: str) -> DataFrame:
    return tables.turtle(triples(spark, d))


@query(TRIPLES + """SELECT subject, '<rdf:Description rdf:about="' || subject || '">' || chr(10) || string_agg('  <' || predicate || '>' || replace(replace(object, '&', '&amp;'), '<', '&lt;') || '</' || predicate || '>', chr(10) ORDER BY predicate, object) || chr(10) || '</rdf:Description>' AS block FROM triples GROUP BY subject""")
def rdf_export(spark: SparkSession, d: str) -> DataFrame:
    return tables.rdf_xml(triples(spark, d))


@query(TRIPLES + """SELECT subject, '{"@id":"' || subject || '",' || string_agg('"' || predicate || '":[' || v || ']', ',' ORDER BY predicate) || '}' AS block FROM (SELECT subject, predicate, string_agg('"' || object || '"', ',' ORDER BY object) AS v FROM triples GROUP BY ALL) GROUP BY subject""")
def json_ld_export(spark: SparkSession, d: str) -> DataFrame:
    return tables.json_ld(triples(spark, d))


@query(TRIPLES + "SELECT *, round(n_triples / n_subjects, 6) AS triples_per_subject FROM (SELECT count(*) AS n_triples, count(DISTINCT subject) AS n_subjects, count(DISTINCT predicate) AS n_predicates, count(DISTINCT object) AS n_objects FROM triples)")
def kg_stats(spark: SparkSession, d: str) -> DataFrame:
    return graph.statistics(triples(spark, d))


@query(TRIPLES + "SELECT predicate, count(*) AS n FROM triples GROUP BY predicate")
def predicate_freq(spark: SparkSession, d: str) -> DataFrame:
    return graph.predicates(triples(spark, d))


@query(
    TRIPLES + ", types AS (SELECT DISTINCT subject, object AS kind FROM triples WHERE predicate = 'rdf:type') SELECT t.predicate, a.kind AS domain, b.kind AS range, count(*) AS n FROM triples t JOIN types a ON a.subject = t.subject JOIN types b ON b.subject = t.object WHERE t.predicate <> 'rdf:type' GROUP BY ALL"
)
def relationship_summary(spark: SparkSession, d: str) -> DataFrame:
    return graph.relationships(triples(spark, d))


@query(TRIPLES + "SELECT * FROM triples WHERE predicate = 'basedIn' AND object = 'nation_3'")
def triple_pattern(spark: SparkSession, d: str) -> DataFrame:
    return graph.match(triples(spark, d), predicate="basedIn", object_="nation_3")


@query(
    TRIPLES + "SELECT DISTINCT a.subject AS s, c.object AS region FROM triples a JOIN triples b ON b.subject = a.object AND b.predicate = 'locatedIn' JOIN triples c ON c.subject = b.object AND c.predicate = 'name' JOIN triples t ON t.subject = a.subject AND t.predicate = 'rdf:type' AND t.object = 'Supplier' WHERE a.predicate = 'basedIn'"
)
def bgp_join(spark: SparkSession, d: str) -> DataFrame:
    patterns = [("?s", "rdf:type", "Supplier"), ("?s", "basedIn", "?n"), ("?n", "locatedIn", "?r"), ("?r", "name", "?region")]
    return sparql.solve(triples(spark, d), patterns).select("s", "region").distinct()


@query(TRIPLES + "SELECT DISTINCT a.subject AS n, b.object AS label FROM triples a JOIN triples b ON b.subject = a.subject AND b.predicate = 'name' WHERE a.predicate = 'locatedIn' AND contains(b.object, 'A') ORDER BY 2, 1 LIMIT 10")
def sparql_select(spark: SparkSession, d: str) -> DataFrame:
    out = sparql.run(triples(spark, d), 'SELECT DISTINCT ?label ?n WHERE { ?n <locatedIn> ?r . ?n <name> ?label . FILTER(CONTAINS(STR(?label), "A")) } LIMIT 10')
    return out.select("n", "label")


@query(
    TRIPLES + "SELECT a.subject AS n, b.object AS label FROM triples a JOIN triples b ON b.subject = a.subject AND b.predicate = 'name' WHERE a.predicate = 'rdf:type' AND a.object = 'Nation' AND b.object <> 'NATION_3' AND (regexp_matches(b.object, '[24]', 'i') OR length(b.object) < 5) AND NOT ends_with(b.object, '2')"
)
def sparql_filters(spark: SparkSession, d: str) -> DataFrame:
    return sparql.run(triples(spark, d), 'SELECT ?n ?label WHERE { ?n a Nation ; name ?label . FILTER(?label != "NATION_3" && (REGEX(?label, "[24]", "i") || STRLEN(?label) < 5)) FILTER(!STRENDS(?label, "2")) }')


@query(TRIPLES + "SELECT a.subject AS n, b.object AS label, c.object AS place FROM triples a LEFT JOIN triples b ON b.subject = a.subject AND b.predicate = 'name' LEFT JOIN triples c ON c.subject = a.subject AND c.predicate = 'locatedIn' AND contains(c.object, '1') WHERE a.predicate = 'rdf:type'")
def sparql_optional(spark: SparkSession, d: str) -> DataFrame:
    return sparql.run(triples(spark, d), 'SELECT ?n ?label ?place WHERE { ?n a ?kind . OPTIONAL { ?n name ?label } OPTIONAL { ?n locatedIn ?place . FILTER(CONTAINS(?place, "1")) } }')


@query(TRIPLES + "SELECT subject AS n, object AS up FROM triples WHERE predicate = 'locatedIn' UNION ALL SELECT subject, object FROM triples WHERE predicate = 'basedIn' AND object IN ('nation_1', 'nation_2')")
def sparql_union(spark: SparkSession, d: str) -> DataFrame:
    return sparql.run(triples(spark, d), 'SELECT ?n ?up WHERE { { ?n locatedIn ?up } UNION { ?n basedIn ?up . FILTER(?up = "nation_1" || ?up = "nation_2") } }')


@query(TRIPLES + "SELECT subject AS n, object AS place FROM triples WHERE predicate = 'basedIn' ORDER BY object DESC, subject LIMIT 20 OFFSET 5")
def sparql_order(spark: SparkSession, d: str) -> DataFrame:
    return sparql.run(triples(spark, d), "SELECT ?n ?place WHERE { ?n basedIn ?place } ORDER BY DESC(?place) ?n LIMIT 20 OFFSET 5")


@query(TRIPLES + "SELECT DISTINCT a.subject, 'inRegion' AS predicate, b.object FROM triples a JOIN triples b ON b.subject = a.object AND b.predicate = 'locatedIn' WHERE a.predicate = 'basedIn' UNION SELECT DISTINCT b.object, 'hosts', a.subject FROM triples a JOIN triples b ON b.subject = a.object AND b.predicate = 'locatedIn' WHERE a.predicate = 'basedIn'")
def sparql_construct(spark: SparkSession, d: str) -> DataFrame:
    return sparql.run(triples(spark, d), "CONSTRUCT { ?s inRegion ?r . ?r hosts ?s } WHERE { ?s basedIn ?n . ?n locatedIn ?r }")


@query(TRIPLES + "SELECT DISTINCT * FROM triples WHERE subject IN ('nation_3', 'nation_4') OR object IN ('nation_3', 'nation_4')")
def sparql_describe(spark: SparkSession, d: str) -> DataFrame:
    return sparql.run(triples(spark, d), 'DESCRIBE <nation_4> ?n WHERE { ?n rdf:type Nation . FILTER(?n = "nation_3") }')


@query(TRIPLES + "SELECT * FROM (SELECT 'predicate' AS kind, predicate AS term, count(*) AS n FROM triples GROUP BY predicate ORDER BY n DESC, term LIMIT 3) UNION ALL SELECT * FROM (SELECT 'type', object, count(*) AS n FROM triples WHERE predicate = 'rdf:type' GROUP BY object ORDER BY n DESC, object LIMIT 3)")
def kg_top_terms(spark: SparkSession, d: str) -> DataFrame:
    return graph.top_terms(triples(spark, d), 3)


@query(
    TRIPLES + """, edges AS (SELECT subject AS a, object AS b FROM triples UNION SELECT object, subject FROM triples),
    near AS (SELECT 'region_1' AS node, 0 AS distance UNION SELECT b, 1 FROM edges WHERE a = 'region_1' AND b <> 'region_1')
    SELECT t.*, least(x.distance, y.distance) AS distance FROM (SELECT DISTINCT * FROM triples) t JOIN near x ON x.node = t.subject JOIN near y ON y.node = t.object"""
)
def explore_triples(spark: SparkSession, d: str) -> DataFrame:
    return graph.explored_triples(triples(spark, d), "region_1", 1)


@query(TRIPLES + "SELECT count(*) > 0 AS answer FROM triples WHERE predicate = 'locatedIn' AND object = 'region_1'")
def sparql_ask(spark: SparkSession, d: str) -> DataFrame:
    return sparql.run(triples(spark, d), "ASK { ?n locatedIn <region_1> }")


@query(
    TRIPLES + """, edges AS (SELECT DISTINCT subject AS a, object AS b FROM triples UNION SELECT object, subject FROM triples),
    one AS (SELECT DISTINCT b AS node FROM edges WHERE a = 'region_1' AND b <> 'region_1'),
    two AS (SELECT DISTINCT e.b AS node FROM edges e JOIN one ON one.node = e.a WHERE e.b <> 'region_1' AND e.b NOT IN (SELECT node FROM one))
    SELECT 'region_1' AS node, 0 AS distance UNION ALL SELECT node, 1 FROM one UNION ALL SELECT node, 2 FROM two"""
)
def explore_depth(spark: SparkSession, d: str) -> DataFrame:
    return graph.explore(triples(spark, d), "region_1", 2)


@query(
    TRIPLES + "SELECT subject AS entity, count(*) AS n_triples FROM triples WHERE contains(lower(subject), 'nation_1') AND subject IN (SELECT subject FROM triples WHERE predicate = 'rdf:type' AND object = 'Nation') GROUP BY subject ORDER BY n_triples DESC, entity LIMIT 50"
)
def entity_search(spark: SparkSession, d: str) -> DataFrame:
    return graph.entity_search(triples(spark, d), "Nation_1", "Nation")


# A small class tree.
CLASSES = (("Nation", "Place"), ("Region", "Place"), ("Place", "Thing"), ("Supplier", "Organisation"), ("Customer", "Agent"), ("Organisation", "Agent"), ("Agent", "Thing"))


@query(
    f"WITH RECURSIVE p(name, parent) AS (VALUES {', '.join(str(c) for c in CLASSES)}), n AS (SELECT name FROM p UNION SELECT parent FROM p), c(name, ancestor) AS (SELECT name, name FROM n UNION SELECT c.name, p.parent FROM c JOIN p ON p.name = c.ancestor) SELECT * FROM c"
)
def ontology_closure(spark: SparkSession, d: str) -> DataFrame:
    return graph.closure(spark.createDataFrame(list(CLASSES), "name string, parent string"))


# Properties with what they may join.
PROPERTIES = (("basedIn", "Organisation", "Place"), ("locatedIn", "Place", "Region"), ("label", None, None))


@query(
    TRIPLES + f""", p(name, parent) AS (VALUES {', '.join(str(c) for c in CLASSES)}), props(name, dom, ran) AS (VALUES {', '.join(str(c).replace('None', 'NULL') for c in PROPERTIES)}),
    up AS (SELECT name, parent AS k FROM p UNION SELECT a.name, b.parent FROM p a JOIN p b ON b.name = a.parent UNION SELECT name, name FROM p UNION SELECT parent, parent FROM p),
    kinds AS (SELECT DISTINCT subject AS node, k FROM triples JOIN up ON up.name = object WHERE predicate = 'rdf:type'), r AS (SELECT t.*, props.name, dom, ran FROM triples t LEFT JOIN props ON props.name = predicate WHERE predicate <> 'rdf:type')
    SELECT subject, predicate, object, 'unknown property' AS error FROM r WHERE name IS NULL
    UNION ALL SELECT subject, predicate, object, 'domain' FROM r WHERE dom IS NOT NULL AND subject IN (SELECT node FROM kinds) AND (subject, dom) NOT IN (SELECT node, k FROM kinds)
    UNION ALL SELECT subject, predicate, object, 'range' FROM r WHERE ran IS NOT NULL AND object IN (SELECT node FROM kinds) AND (object, ran) NOT IN (SELECT node, k FROM kinds)"""
)
def ontology_errors(spark: SparkSession, d: str) -> DataFrame:
    classes = spark.createDataFrame(list(CLASSES), "name string, parent string")
    return graph.ontology_errors(triples(spark, d), spark.createDataFrame(list(PROPERTIES), "name string, domain string, range string"), classes)


@query(TRIPLES + "SELECT subject, predicate, object FROM triples WHERE length(object) >= 3 AND predicate IN ('name', 'locatedIn')")
def valid_triples(spark: SparkSession, d: str) -> DataFrame:
    properties = spark.createDataFrame([("name",), ("locatedIn",)], "name string")
    return graph.valid_triples(triples(spark, d).withColumn("confidence", F.lit(0.8)), properties).select("subject", "predicate", "object")


#: The vector that searches start from, by rule.
QUERY = [((7 * k) % 11 - 5) / 10 for k in range(64)]
_Q = "[" + ", ".join(f"CAST({x} AS DOUBLE)" for x in QUERY) + "]"
_SCORE = f"round(list_dot_product(CAST(embedding AS DOUBLE[]), {_Q}) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * {sum(x * x for x in QUERY) ** 0.5}), 6)"


@query(f"SELECT vec_id, label, {_SCORE} AS score FROM embeddings WHERE {_SCORE} >= 0.0 ORDER BY score DESC, vec_id LIMIT 10")
def semantic_topk(spark: SparkSession, d: str) -> DataFrame:
    return vectors.top_similar(table(spark, d, "embeddings"), QUERY, 10)


@query(f"SELECT vec_id, label, {_SCORE} AS score FROM embeddings WHERE {_SCORE} >= 0.0 AND vec_id % 3 = 1 AND label IN (SELECT label FROM embeddings WHERE vec_id % 100 = 0) ORDER BY score DESC, vec_id LIMIT 10")
def semantic_filtered(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    return vectors.top_similar(rows, QUERY, 10, condition=F.col("vec_id") % 3 == 1, among=rows.where("vec_id % 100 = 0").select("label"))


@query(
    TRIPLES + f", v AS (SELECT vec_id, {_SCORE} AS score FROM embeddings WHERE {_SCORE} >= 0.0 ORDER BY score DESC, vec_id LIMIT 100), g AS (SELECT subject, count(*) AS n FROM triples WHERE predicate = 'basedIn' GROUP BY subject) SELECT vec_id, round(0.7 * score + 0.3 * coalesce(n, 0), 6) AS combined FROM v LEFT JOIN g ON g.subject = 'customer_' || vec_id"
)
def hybrid_query(spark: SparkSession, d: str) -> DataFrame:
    hits = vectors.top_similar(table(spark, d, "embeddings"), QUERY, 100).withColumn("subject", _name("customer", "vec_id"))
    facts = graph.match(triples(spark, d), predicate="basedIn").groupBy("subject").agg(F.count("*").alias("n"))
    return hits.join(facts, "subject", "left").select("vec_id", F.round(0.7 * F.col("score") + 0.3 * F.coalesce("n", F.lit(0)), 6).alias("combined"))
