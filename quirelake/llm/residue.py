"""Residue in place of content: unfilled templates, filler, error pages, notices that scripts are required.

Labelled exemplars are indexed by term: words, pairs of neighbouring words, and
the shapes of placeholders. The index gives the exemplars that share terms with
a text; in every passage window of the text the shared TF-IDF mass, as a part of
the exemplar's own, says how far the window contains it. Term weights come from
the exemplars and, where given, from a clean background, never from the records
themselves, so residue is found alike however common it is. Exemplars of real
content compete, so that a message which only resembles residue is kept.

Running filler has no fixed wording. Its words are learned from the records: a
word that stands almost only in windows with words of filler already known is
one itself. A window that such words cover is filler.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.common import durable, sent_if_small

#: Tokens in a passage window, and the step from one window to the next.
WINDOW, STEP = 12, 6
#: Least part of an exemplar's mass that a window must hold, and least part of a window's words that filler must cover.
CONTAINED, COVERED = 0.72, 0.8
#: Least part of the greatest weight that a term has.
LEAST = 0.5
#: Least number of different filler words in a window that filler covers.
FILLER_WORDS = 3
#: Rounds in which filler words are learned; least windows of filler with such a word, and least part of all its windows that they are.
ROUNDS, FILLER_SEEN, FILLER_SHARE = 2, 3, 0.6

# Exemplars of residue. '§' stands for a placeholder of any shape, '#' for a number. Words joined by ' + ' may stand in any order
# within a window, others stand side by side. Phrases of HTTP status codes are those of the standard, with their translations.
RESIDUE = {
    "template": (
        "§", "click to add", "click to edit", "text goes here", "description goes here", "enter + description + here", "enter + text + here", "type + text + here", "insert + caption", "insert + image", "insert + text", "insert + title",
        "add + description + here", "add + caption + here", "replace this text", "todo + describe", "todo + add", "todo + write", "todo + fill", "placeholder text", "placeholder + caption", "placeholder + description", "sample + caption", "sample text",
        "hier + einfügen", "hier + eingeben", "platzhaltertext", "beispieltext", "à compléter", "à remplir", "saisir + ici", "texte à insérer", "insertar + aquí", "escriba + aquí", "texto de ejemplo", "inserire + qui", "testo di esempio",
        "voer + hier + in", "voorbeeldtekst", "insira + aqui", "texto de exemplo", "wstaw + tutaj", "wpisz + tutaj", "tekst przykładowy",
    ),
    "filler": (
        "lorem ipsum", "dummy text", "dummy copy", "placeholder copy", "filler text", "blindtext", "fülltext", "texte de remplissage", "faux texte", "texto de relleno", "testo segnaposto", "testo di riempimento", "opvultekst", "texto de preenchimento", "tekst zastępczy",
        "asdf", "qwerty", "blah blah", "bla bla", "foo bar", "xxx xxx", "test test", "text text",
    ),
    "error page": (
        "# bad request", "# unauthorized", "# payment required", "# forbidden", "# not found", "# method not allowed", "# not acceptable", "# request timeout", "# conflict", "http # gone", "# gone", "# too many requests", "# internal server error", "internal server error",
        "# not implemented", "# bad gateway", "# service unavailable", "# gateway timeout", "# gateway time out", "http error #", "error # something", "something went wrong", "access denied", "page not found", "page does not exist", "page + no + longer + exists", "page + moved + not + exist",
        "service + maintenance", "site + maintenance", "session has expired", "session expired", "sign in again", "log in again", "not + found + on this server", "address + not + on this server", "contact the administrator", "contact + server administrator", "try again later", "try again in", "back to the start page", "back to the home page", "back to homepage",
        "fehler #", "interner serverfehler", "seite nicht gefunden", "seite + existiert + nicht", "seite + nicht + verfügbar", "zugriff verweigert", "sitzung + abgelaufen", "zurück zur startseite", "versuchen sie es später",
        "erreur #", "page introuvable", "page non trouvée", "accès refusé", "accès interdit", "session + expiré", "erreur interne du serveur", "retour + accueil", "retournez + d'accueil", "réessayez plus tard",
        "página no encontrada", "acceso denegado", "error interno del servidor", "sesión + caducado", "pagina non trovata", "accesso negato", "errore interno del server", "sessione + scaduta", "pagina niet gevonden", "toegang geweigerd", "sessie + verlopen", "interne serverfout",
        "página não encontrada", "acesso negado", "erro interno do servidor", "sessão + expirou", "nie znaleziono strony", "strona nie istnieje", "odmowa dostępu", "sesja wygasła", "wewnętrzny błąd serwera",
    ),
    "script notice": tuple(
        f"{verb} + javascript"
        for verb in (
            "enable enabled enabling activate allow need needs require requires required must turn turned switch switched disabled deactivated unsupported blocked "
            "aktivieren aktiviert benötigt erfordert erforderlich deaktiviert ausgeschaltet einschalten erlauben ohne "
            "activer activez autoriser autorisez exige nécessite requis désactivé active activar habilite habilitar requiere desactivado "
            "abilitare abilita attivare attiva richiede richiesto disabilitato schakel zet inschakelen vereist vereiste uitgeschakeld "
            "ative ativar habilitar exige requer desativado włącz włączyć wymaga wyłączony"
        ).split()
    ) + ("only with javascript", "browser + not + javascript", "without javascript + cannot"),
}

# Fixed value: the words of the common filler sentence in pseudo-Latin, from which the others are learned.
FILLER_SEEDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua"

# Exemplars of real content that resembles residue.
CLEAN = (
    "file not found", "file not found § pdf", "http # from + server", "# for image", "relation missing", "javascript actions", "javascript + ignored", "template sheet", "slide template", "option + javascript", "javascript + check boxes", "javascript + checkbox",
    "error rates", "responses + per hour", "form with empty fields", "formular + leeren feldern", "browser window with", "could not be loaded", "could not be rendered", "konnte nicht gerendert werden", "timeout after # s", "gave no answer",
)

# The shapes of placeholders, for Java's regular expressions.
_PLACEHOLDERS = (
    r"\{\{\s*[A-Za-z_][\w.]*(?:\s*\|[^{}]*)?(?:\s*\}\})?",
    r"\{%.*?%\}",
    r"<%.*?%>",
    r"[#$]\{\s*[A-Za-z_][\w.]*\s*\}",
    r"(?<![\\\w^}])\{[A-Za-z][A-Za-z_]{2,}\}",
    r"@@\s*[A-Za-z_]+\s*@@",
    r"\[\[\s*[A-Za-z_]+\s*\]\]",
    r"(?<![\w\]])\[[A-Za-z][A-Za-zÄÖÜäöü_]{2,}\](?!\()",
    r"(?<![\w%])%[A-Za-z_]{2,}%(?!\w)",
    r"(?<!\w)__[A-Za-z][A-Za-z_]*__(?!\w)",
    r"<insert [A-Za-z_ ]+>",
    r"<(?!/|(?i:html|head|title|body|noscript|script|style|meta|link|div|span|table|thead|tbody|tr|td|th|ul|ol|li|p|br|hr|img|a|b|i|u|em|strong|sub|sup|pre|text|picture|formula|doctag|caption)>)[A-Za-z][A-Za-z_]+>",
    r"(?<![\w%])%[sd](?!\w)",
)
_SHAPE = "|".join(f"(?:{p})" for p in _PLACEHOLDERS)
_TOKEN = r"(§|#|[\p{L}]+(?:['’][\p{L}]+)?)"


def tokens_of(text: Column) -> Column:
    """The tokens of a text: words in lower case, ``#`` for numbers, ``§`` for placeholders; without what stands in quotation marks."""
    text = F.regexp_replace(text, r'"[^"\n]{1,120}"|„[^“”\n]{1,120}[“”]|“[^”\n]{1,120}”|«[^»\n]{1,120}»', " ")
    text = F.regexp_replace(text, r"<(?:html|head|title|body|h1|noscript)>", " ")
    text = F.regexp_replace(text, _SHAPE, " § ")
    text = F.regexp_replace(F.lower(text), r"<[^<>]*>", " ")
    text = F.regexp_replace(text, r"\bjava\s?script\b|\bjs\b|\bscripting\b", "javascript")
    text = F.regexp_replace(text, r"\p{Lu}?\d[\d.,/:-]*", " # ")
    return F.regexp_extract_all(text, F.lit(_TOKEN), 1)


def _terms(tokens: Column) -> Column:
    """Words and pairs of neighbouring words, each once."""
    pairs = F.when(F.size(tokens) > 1, F.transform(F.sequence(F.lit(1), F.size(tokens) - 1), lambda k: F.concat_ws(" ", F.element_at(tokens, k), F.element_at(tokens, k + 1))))
    return F.array_distinct(F.concat(tokens, F.coalesce(pairs, F.array().cast("array<string>"))))


def _exemplar_terms(text: str) -> set[str]:
    """The terms of an exemplar: its words, and the pairs of words that stand side by side in it."""
    parts = [part.split() for part in text.split(" + ")]
    return {w for part in parts for w in part} | {" ".join(pair) for part in parts for pair in zip(part, part[1:], strict=False)}


def exemplar_index(spark: SparkSession, background: DataFrame | None = None) -> DataFrame:
    """The inverted index of all exemplars, ``(term, exemplar, kind, w, mass)``, as many rows as the fixed lists give.

    ``w`` is the smoothed inverse document frequency of the term among the texts
    of ``background`` (``body``), at least ``LEAST`` of the greatest there can
    be, so that no single word stands for an exemplar of two; ``mass`` is the
    exemplar's sum of it.
    """
    texts = [("residue", t) for kind in RESIDUE.values() for t in dict.fromkeys(kind)] + [("clean", t) for t in CLEAN]
    rows = [{"term": term, "exemplar": n, "kind": kind} for n, (kind, text) in enumerate(texts) for term in sorted(_exemplar_terms(text))]
    # A literal instead of rows from Python, so that no Python worker is needed.
    index = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), "array<struct<term: string, exemplar: int, kind: string>>")))
    known = index.select("term").distinct()
    size, there = F.lit(0), F.lit(0)
    if background is not None:
        # One row of counts for each of the index's own terms, summed up before it is shuffled.
        cut = background.where("body IS NOT NULL").select(tokens_of(F.col("body")).alias("tokens"))
        counts = cut.select(F.explode(_terms(F.col("tokens"))).alias("term")).join(F.broadcast(known), "term").groupBy("term").agg(F.count("*").alias("there"))
        known = known.join(F.broadcast(counts), "term", "left")
        size, there = cut.agg(F.count("*")).scalar(), F.coalesce("there", F.lit(0))
    weights = known.select("term", F.greatest(F.log((size + 1.0) / (there + 0.5)), LEAST * F.log((size + 1.0) / 0.5)).alias("w"))
    index = index.join(F.broadcast(weights), "term")
    return index.withColumn("mass", F.sum("w").over(Window.partitionBy("exemplar")))


def filler_words(cells: DataFrame) -> DataFrame:
    """The words of running filler, ``(term)``: the seeds, and what stands almost only beside them.

    ``cells`` has each different word of each window once, as ``(text_id,
    window, term)``; null texts and empty tables have none. Each round takes the
    windows with two or more words known so far, and learns the words of which
    ``FILLER_SEEN`` windows, and ``FILLER_SHARE`` of all their windows, are such.
    """
    known = F.broadcast(cells.sparkSession.range(1).select(F.explode(F.array_distinct(F.split(F.lit(FILLER_SEEDS), " "))).alias("term")))
    for _ in range(ROUNDS):
        filled = sent_if_small(cells.join(known, "term", "left_semi").groupBy("text_id", "window").agg(F.count("*").alias("n")).where("n >= 2").select("text_id", "window"))
        beside = sent_if_small(cells.join(filled, ["text_id", "window"], "left_semi").groupBy("term").agg(F.count("*").alias("m")).where(F.col("m") >= FILLER_SEEN))
        everywhere = cells.join(beside.select("term"), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
        known = sent_if_small(everywhere.join(beside, "term").where(F.col("m") >= FILLER_SHARE * F.col("n")).select("term"))
    return known


def score_windows(records: DataFrame, text_col: str = "body", background: DataFrame | None = None) -> DataFrame:
    """For each record ``(source_table, row_id)`` with a match: the best containment of a residue and of a clean exemplar in a window, and the best cover by filler.

    Containments below ``CONTAINED`` may be missing. Repeated records are scored once.
    """
    # Equal texts have equal scores, so each different text is scored once; it is cut into tokens once, for all that follows.
    texts = records.where(F.col(text_col).isNotNull()).select(text_col).distinct().withColumn("text_id", F.md5(text_col))
    # What has none is left out afterwards, since a filter would be moved before the distinct and cut all copies.
    tokens = durable(texts.select("text_id", tokens_of(F.col(text_col)).alias("tokens"))).where(F.size("tokens") > 0)
    postings = durable(exemplar_index(records.sparkSession, background))
    # A window that holds CONTAINED of an exemplar has one of the heaviest terms that together weigh more than the rest may; only those are searched.
    before = F.coalesce(F.sum("w").over(Window.partitionBy("exemplar").orderBy(F.desc("w"), "term").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    searched = postings.withColumn("before", before).where(F.col("before") <= (1 - CONTAINED) * F.col("mass") + 1e-6).select("term", "exemplar")
    hits = sent_if_small(tokens.select("text_id", F.explode(_terms(F.col("tokens"))).alias("term")).join(F.broadcast(searched), "term").select("text_id", "exemplar").distinct())
    exemplars = postings.groupBy("exemplar", "kind", "mass").agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("weights"))
    matched = tokens.join(hits, "text_id").join(F.broadcast(exemplars), "exemplar")

    def shared(window: Column) -> Column:
        return F.aggregate(_terms(window), F.lit(0.0), lambda mass, term: mass + F.coalesce(F.try_element_at("weights", term), F.lit(0.0)))

    matched = matched.select("text_id", "kind", (F.array_max(F.transform(_windows(F.col("tokens")), shared)) / F.col("mass")).alias("contained"))
    best = matched.groupBy("text_id").agg(F.max(F.when(F.col("kind") == "residue", F.col("contained"))).alias("residue"), F.max(F.when(F.col("kind") == "clean", F.col("contained"))).alias("clean"))
    filler = _filler_cover(tokens)
    keyed = records.where(F.col(text_col).isNotNull()).select("source_table", "row_id", F.md5(text_col).alias("text_id"))
    scored = keyed.join(sent_if_small(best.join(filler, "text_id", "full")), "text_id")
    return scored.groupBy("source_table", "row_id").agg(F.max("residue").alias("residue"), F.max("clean").alias("clean"), F.max("filler").alias("filler"))


def _windows(tokens: Column) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(tokens) - STEP - 1), F.lit(STEP))
    return F.transform(starts, lambda k: F.slice(tokens, k + 1, F.lit(WINDOW)))


def _filler_cover(tokens: DataFrame) -> DataFrame:
    """``(text_id, filler)``: the greatest part of the different words of a window that are filler, where there are at least ``FILLER_WORDS``."""
    starts = F.sequence(F.lit(0), F.size("tokens") - 1, F.lit(WINDOW))
    apart = tokens.select("text_id", F.posexplode(F.transform(starts, lambda k: F.array_distinct(F.slice("tokens", k + 1, F.lit(WINDOW))))).alias("window", "words"))
    cells = durable(apart.select("text_id", "window", F.explode("words").alias("term")))
    own = sent_if_small(cells.join(filler_words(cells), "term", "left_semi").groupBy("text_id").agg(F.collect_set("term").alias("own")).where(F.size("own") >= FILLER_WORDS), 20_000)

    def cover(window: Column) -> Column:
        words = F.array_distinct(window)
        known = F.size(F.array_intersect(words, F.col("own")))
        return F.when(known >= FILLER_WORDS, known / F.size(words))

    return tokens.join(own, "text_id").select("text_id", F.array_max(F.transform(_windows(F.col("tokens")), cover)).alias("filler")).where("filler IS NOT NULL")


def residue_records(records: DataFrame, text_col: str = "body", background: DataFrame | None = None) -> DataFrame:
    """``(source_table, row_id)`` of the records whose text is or contains residue.

    ``records`` has ``source_table``, ``row_id`` and the text; ``background`` a
    bounded number of clean texts as ``body``, from which terms get their
    weights. Null, empty and blank texts are none. A record comes out once,
    however often it is given.
    """
    scores = score_windows(records, text_col, background)
    residue, clean = F.coalesce("residue", F.lit(0.0)), F.coalesce("clean", F.lit(0.0))
    return scores.where((F.coalesce("filler", F.lit(0.0)) >= COVERED) | ((residue >= CONTAINED) & (residue >= clean))).select("source_table", "row_id")


def without_residue(records: DataFrame, text_col: str = "body", background: DataFrame | None = None) -> DataFrame:
    """``records`` without those that ``residue_records`` finds; other columns stay."""
    return records.join(sent_if_small(residue_records(records, text_col, background)), ["source_table", "row_id"], "left_anti")
