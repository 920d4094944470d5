"""Prompts for outside models, from fixed templates or files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

# The headings of prompts with context.
PREVIOUS, TASK, TEXT = "VORHERIGER KONTEXT:\n", "AUFGABE:\n", "TEXT:\n"
# The lines of the prompt that asks for a context summary besides the task.
SUMMARY = (
    "ZUSÄTZLICHE AUFGABE: Erstelle eine Kontextzusammenfassung für nachfolgende Textabschnitte.", "", "Die Kontextzusammenfassung soll:", "1. Kernthemen und wichtige Konzepte erfassen", "2. Relevante Definitionen und Erklärungen enthalten",
    "3. Wichtige Referenzen und Verweise festhalten", "4. Den thematischen 'roten Faden' bewahren", "5. Maximal 300 Tokens umfassen", "",
)
OUTPUT = ("", "AUSGABEFORMAT:", "HAUPTAUFGABE ERGEBNIS:", "[Hier das Ergebnis der Hauptaufgabe]", "", "KONTEXT FÜR NACHFOLGENDE ABSCHNITTE:", "[Kompakte Zusammenfassung der relevanten Kontextinformationen]")
# The focus and the instructions for each type of visual element; other types are described.
FOCUS = {
    "chart": ("chart_data", ("Extract all data points and values", "Identify axis labels and units", "Describe the chart type (bar, line, pie, etc.)", "Summarize key trends or insights", "Extract legend information if present")),
    "diagram": ("comprehensive", ("Describe the diagram structure and components", "Identify relationships between elements", "Extract any text labels or annotations", "Explain the diagram's purpose or meaning", "Note any flow directions or hierarchies")),
    "formula": ("ocr", ("Extract the mathematical formula in LaTeX format", "Identify all variables and symbols", "Preserve subscripts and superscripts", "Note any special mathematical notation", "Provide the formula meaning if apparent")),
    "table": ("ocr", ("Extract table structure with headers", "Preserve row and column relationships", "Extract all cell values accurately", "Note any merged cells or special formatting", "Identify table caption if present")),
    "table_image": ("ocr", ("Extract table structure with headers", "Preserve row and column relationships", "Extract all cell values accurately", "Note any merged cells or special formatting", "Identify table caption if present")),
    "screenshot": ("comprehensive", ("Describe the UI elements visible", "Extract any text content", "Identify the application or system shown", "Note any important data or status indicators", "Describe user interactions if apparent")),
}
DESCRIBE = ("description", ("Provide detailed description of the visual content", "Identify main subjects or objects", "Note colors, composition, and style", "Extract any visible text", "Explain the image's purpose in the document context"))


def with_context(task: str, content: Column, inherited: Column) -> Column:
    """The task on a text, after the context it inherits where there is any."""
    before = F.when(F.coalesce(inherited, F.lit("")) != "", F.concat(F.lit(PREVIOUS), inherited, F.lit("\n")))
    return F.concat_ws("\n", before, F.lit(f"{TASK}{task}\n"), F.concat(F.lit(TEXT), F.coalesce(content, F.lit(""))))


def context_generation(task: str, content: Column) -> Column:
    """The task on the first text of a group, which also makes the context of the others."""
    head = "\n".join((f"HAUPTAUFGABE: {task}", "", *SUMMARY))
    return F.concat(F.lit(head + "\n" + TEXT), F.coalesce(content, F.lit("")), F.lit("\n" + "\n".join(OUTPUT)))


def extraction(text: Column, most: int = 50, language: str = "de", ontology: str | None = None) -> Column:
    """The prompt that asks for the triples of a text as JSON; null for null."""
    rules = f"List up to {most} triples of the text as JSON: an object with the key triples, whose entries have subject, predicate, object, confidence from 0 to 1 and optionally context. Language: {language}. Keep names as they are written.\n"
    return F.concat(F.lit(rules + (f"\nOntology:\n{ontology}\n" if ontology else "") + "\nText:\n"), text)


def from_template(template: str, values: dict[str, Column]) -> Column:
    """A template with each ``{name}`` replaced by its value, null counting as empty; other braces stay. Values are not searched for names again."""
    parts: list[Column] = []
    rest = template
    while rest:
        found = min(((rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest), default=None)
        if found is None:
            parts.append(F.lit(rest))
            break
        at, name = found
        parts += [F.lit(rest[:at]), F.coalesce(values[name].cast("string"), F.lit(""))]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts) if parts else F.lit("")


def load_template(path: str) -> str:
    """The template in a file."""
    return Path(path).read_text(encoding="utf-8")


def adaptive(kind: Column) -> tuple[Column, Column]:
    """The focus and the instructions for a type of visual element."""
    focus = F.create_map(*(F.lit(x) for k, (f, _) in FOCUS.items() for x in (k, f)))
    lines = F.create_map(*(x for k, (_, i) in FOCUS.items() for x in (F.lit(k), F.array(*(F.lit(t) for t in i)))))
    return F.coalesce(F.try_element_at(focus, kind), F.lit(DESCRIBE[0])), F.coalesce(F.try_element_at(lines, kind), F.array(*(F.lit(t) for t in DESCRIBE[1])))
