"""Texts that were cut off, found in SQL by what their last three tokens do elsewhere.

Token trigrams are counted inside all texts and at their ends. A text was cut
if its last trigram is frequent inside texts but almost never ends one. The
last token may be the beginning of a word, so words are met by those of their
prefixes that end a text, by equality; a trigram seldom seen backs off to its
last two tokens, then to the last one, and where that is unknown too to the
trigram before it.
Texts whose first three tokens begin texts that as a rule have no final
punctuation are captions, which end without it. Punctuation marks are tokens,
which is why the last words of whole sentences, whose last token is a full stop,
never count as ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.common import durable, sent_if_small

#: Least count inside texts, and greatest ratio of ends to it, for a text without final punctuation.
INSIDE, END_RATIO = 2, 0.5
#: Texts beginning alike are captions if less than this part of them has final punctuation; smoothed, so that rare beginnings are none.
CAPTION, CAPTION_PRIOR = 0.3, 2
#: As INSIDE and END_RATIO, for a text that ends in final punctuation, where the cut must be proven more strictly.
INSIDE_CLOSED, END_RATIO_CLOSED = 20, 0.02
#: Letters up to which every prefix of a word is looked up as such.
LONGEST = 40

# Marks that stand in place of the rest of a text.
MARKS = r"(?:\.\.\.|…|\[\.\.\.\]|\[…\]|\(\.\.\.\)|\(…\)|\(more\)|\[more\]|\(continued\)|\(cont\.\)|\[truncated\]|\(truncated\)|<truncated>|�+)"

_TOKENS = r"""
WITH cut AS (
  SELECT source_table, row_id, regexp_like(body, '(?i){marks}\\s*$') AS marked,
         rtrim(regexp_replace(regexp_replace(body, '(?i){marks}\\s*$', ''), '\\s+$', '')) AS core
  FROM {records} WHERE body IS NOT NULL AND trim(body) <> ''
)
SELECT source_table, row_id, marked, regexp_like(core, '[.!?。！？]["\'”»)\\]]*$') AS closed,
       regexp_like(core, '[.!?。！？]["\'”»)\\]]*(\\s|$)') AS has_sentence,
       concat(array('^', '^'), regexp_extract_all(
         regexp_replace(lower(core), '\\p{{L}}?\\d+(?:[.,:/-]\\d+)*[/-]?', '#'),
           '(#|\\p{{L}}+(?:[\'’]\\p{{L}}*)*|[^\\s\\p{{L}}])', 1)) AS t
FROM cut
"""

_GRAMS = """
SELECT g.a, g.b, g.c, count_if(g.k < n) AS inside, count_if(g.k = n) AS ends
FROM (
  SELECT size(t) - 2 AS n, explode(transform(sequence(1, size(t) - 2),
         i -> named_struct('k', i, 'a', element_at(t, i), 'b', element_at(t, i + 1), 'c', element_at(t, i + 2)))) AS g
  FROM {tokens} WHERE size(t) > 2
)
GROUP BY g.a, g.b, g.c
"""

_FINALS = """
SELECT source_table, row_id, marked, closed, has_sentence, element_at(t, -3) AS a, element_at(t, -2) AS b, element_at(t, -1) AS c,
       try_element_at(t, -4) AS before, concat_ws(' ', slice(t, 3, 3)) AS head
FROM {tokens} WHERE size(t) > 2
"""

# The words that begin with the last token of some open text. Every prefix of every different word is made once and met by equality; beyond
# LONGEST letters, where a prefix would be made for each letter of a very long token, one prefix stands for all longer ones and they are compared.
_BEGUN = """
SELECT s.c, s.inside, s.ends, stem
FROM (SELECT c, inside, ends, explode(transform(sequence(1, least(length(c), {longest})), n -> left(c, n))) AS part
      FROM (SELECT c, sum(inside) AS inside, sum(ends) AS ends FROM {grams} GROUP BY c)) s
JOIN (SELECT DISTINCT c AS stem FROM {finals} WHERE NOT closed) ON part = left(stem, {longest}) AND startswith(s.c, stem)
"""

# What is looked up: the ends of open texts, their last two tokens, whole trigrams, and for each word the open ends it begins with.
_OPENED = "SELECT DISTINCT a, b, c AS stem FROM {finals} WHERE NOT closed"
_PAIRED = "SELECT DISTINCT b, stem FROM {opened}"
_ASKED = """
SELECT DISTINCT ask.a, ask.b, ask.c FROM (
  SELECT explode(IF(closed, IF(b = '#', array(named_struct('a', a, 'b', b, 'c', c), named_struct('a', before, 'b', a, 'c', '#')), array(named_struct('a', a, 'b', b, 'c', c))),
                    array(named_struct('a', before, 'b', a, 'c', b)))) AS ask
  FROM {finals})
WHERE ask.a IS NOT NULL
"""
_REACH = "SELECT c, collect_list(stem) AS stems FROM {begun} GROUP BY c"

_FOUND = """
WITH one AS (SELECT stem, sum(inside) AS inside, sum(IF(c = stem, ends, 0)) AS ends FROM {begun} GROUP BY stem),
begun_grams AS (SELECT a, b, c, inside, ends, explode(stems) AS stem FROM {grams} JOIN {reach} USING (c)),
two AS (
  SELECT b, stem, sum(inside) AS inside, sum(IF(c = stem, ends, 0)) AS ends FROM begun_grams LEFT SEMI JOIN {paired} USING (b, stem) GROUP BY b, stem
),
three AS (
  SELECT a, b, stem, sum(inside) AS inside, sum(IF(c = stem, ends, 0)) AS ends FROM begun_grams LEFT SEMI JOIN {opened} USING (a, b, stem) GROUP BY a, b, stem
),
exact AS (SELECT g.* FROM {grams} g LEFT SEMI JOIN {asked} USING (a, b, c)),
families AS (
  SELECT head, (count_if(closed) + {prior}) / (count(*) + {prior}) < {caption} AS is_caption
  FROM {finals} WHERE NOT marked GROUP BY head
),
scored AS (
  SELECT coalesce(families.is_caption, false) AS is_caption, f.source_table, f.row_id, f.marked, f.closed, f.has_sentence, f.b, f.c,
         coalesce(three.inside, whole.inside, 0) AS inside3, coalesce(three.ends, whole.ends, 0) AS ends3,
         coalesce(two.inside, 0) AS inside2, coalesce(two.ends, 0) AS ends2,
         coalesce(one.inside, 0) AS inside1, coalesce(one.ends, 0) AS ends1,
         coalesce(earlier.inside, 0) AS inside0, coalesce(earlier.ends, 0) AS ends0
  FROM {finals} f
  LEFT JOIN families ON families.head = f.head
  LEFT JOIN three ON NOT f.closed AND three.a = f.a AND three.b = f.b AND three.stem = f.c
  LEFT JOIN two ON NOT f.closed AND two.b = f.b AND two.stem = f.c
  LEFT JOIN one ON NOT f.closed AND one.stem = f.c
  LEFT JOIN exact whole ON f.closed AND whole.a = f.a AND whole.b = f.b AND whole.c = f.c
  LEFT JOIN exact earlier ON (NOT f.closed OR f.b = '#') AND earlier.a = f.before AND earlier.b = f.a AND earlier.c = f.b
)
SELECT DISTINCT source_table, row_id FROM scored WHERE CASE
    WHEN marked THEN has_sentence OR inside3 >= {inside} OR inside2 >= {inside}
    WHEN closed THEN (inside3 >= {inside_closed} AND ends3 <= {ratio_closed} * inside3)
                  OR (b = '#' AND c IN ('.', ',') AND inside0 >= {inside_closed} AND inside3 <= {ratio_closed} * inside0)
    WHEN is_caption THEN false
    WHEN inside3 >= {inside} THEN ends3 <= {ratio} * inside3 + 1
    WHEN inside2 >= {inside} THEN ends2 <= {ratio} * inside2 + 1
    WHEN inside1 >= {inside} THEN has_sentence AND ends1 <= {ratio} * inside1 + 1
    ELSE has_sentence AND inside0 >= {inside} AND ends0 <= {ratio} * inside0
  END
"""


def truncated_records(records: DataFrame) -> DataFrame:
    """``(source_table, row_id)`` of the records whose ``body`` was cut off.

    Null, empty and blank texts are none, nor are captions whose last words end
    texts as a rule. A record comes out once, however often it is given; other
    columns are not read.
    """
    spark = records.sparkSession
    # Cut into tokens once; tokens and trigrams are read several times below, so each is written once.
    tokens = durable(spark.sql(_TOKENS.replace("{marks}", MARKS.replace("\\", "\\\\")), records=records))
    grams = durable(spark.sql(_GRAMS, tokens=tokens))
    finals = spark.sql(_FINALS, tokens=tokens)
    begun = durable(spark.sql(_BEGUN.replace("{longest}", str(LONGEST)), grams=grams, finals=finals))
    # Looked up by broadcast where there are few, so that the trigrams are not moved for it.
    opened = sent_if_small(spark.sql(_OPENED, finals=finals))
    paired = sent_if_small(spark.sql(_PAIRED, opened=opened))
    asked = sent_if_small(spark.sql(_ASKED, finals=finals))
    reach = sent_if_small(spark.sql(_REACH, begun=begun))
    limits = {"inside": INSIDE, "ratio": END_RATIO, "inside_closed": INSIDE_CLOSED, "ratio_closed": END_RATIO_CLOSED, "caption": CAPTION, "prior": CAPTION_PRIOR}
    sql = _FOUND
    for name, value in limits.items():
        sql = sql.replace("{" + name + "}", str(value))
    return spark.sql(sql, grams=grams, finals=finals, begun=begun, reach=reach, opened=opened, paired=paired, asked=asked)


def truncation_rates(records: DataFrame, origin: str = "model_used") -> DataFrame:
    """How often each origin truncates: ``(source_table, <origin>, n_texts, n_truncated, truncation_rate)``.

    Only records with a text that is not blank count. A null origin is an origin of its own.
    """
    # Read twice below, so whatever was left out before is left out once.
    records = durable(records.select("source_table", "row_id", "body", origin))
    found = truncated_records(records).withColumn("was_cut", F.lit(1))
    rows = records.where("trim(body) <> ''").join(found, ["source_table", "row_id"], "left")
    out = rows.groupBy("source_table", origin).agg(F.count("*").alias("n_texts"), F.count("was_cut").alias("n_truncated"))
    return out.withColumn("truncation_rate", F.round(F.col("n_truncated") / F.col("n_texts"), 6))
