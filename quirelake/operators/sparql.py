"""A subset of SPARQL over a triples table ``(subject, predicate, object)``.

SELECT, ASK, CONSTRUCT and DESCRIBE over triple patterns, FILTER, OPTIONAL,
UNION, ORDER BY, LIMIT and OFFSET. Whatever is not understood in full raises
ValueError; nothing of a query is left out silently. Terms are compared as the
table holds them: names with a prefix as they are written, IRIs without their
angle brackets, literals without their quotes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pattern = tuple[str, str, str]

_TOKENS = re.compile(
    r"""\s*(?:\#[^\n]*\n\s*)*(?:
      (?P<string>"(?:[^"\\]|\\.)*"(?:@[\w-]+|\^\^\S+?(?=[\s,;.)}]))?|'(?:[^'\\]|\\.)*')
    | (?P<var>[?$]\w+)
    | (?P<op>\|\||&&|!=|<=|>=|[{}().;,*=!]|<(?=[\s\d?"'])|>)
    | (?P<iri><[^<>\s]*>)
    | (?P<number>[+-]?\d+(?:\.\d+)?)
    | (?P<name>[\w:%@-]+(?:\.[\w:%@-]+)*)
    )""",
    re.X,
)
# The functions of filters that are known.
_FUNCTIONS = {"CONTAINS": 2, "STRSTARTS": 2, "STRENDS": 2, "REGEX": 2, "LCASE": 1, "UCASE": 1, "STR": 1, "STRLEN": 1, "BOUND": 1}
_WORDS = frozenset("SELECT ASK CONSTRUCT DESCRIBE WHERE FILTER OPTIONAL UNION ORDER BY ASC DESC LIMIT OFFSET DISTINCT PREFIX BASE GRAPH MINUS BIND VALUES SERVICE EXISTS NOT HAVING GROUP AS REDUCED FROM".split())


@dataclass
class Group:
    """A group of patterns: what must match, what is filtered, what may match, and alternatives."""

    patterns: list[Pattern] = field(default_factory=list)
    filters: list[tuple] = field(default_factory=list)
    optionals: list[Group] = field(default_factory=list)
    unions: list[list[Group]] = field(default_factory=list)


@dataclass
class Sparql:
    """What a query text says."""

    form: str
    where: Group
    variables: list[str] = field(default_factory=list)
    template: list[Pattern] = field(default_factory=list)
    described: list[str] = field(default_factory=list)
    distinct: bool = False
    order: list[tuple[str, bool]] = field(default_factory=list)
    limit: int | None = None
    offset: int = 0


class _Reader:
    """The tokens of a query, read from left to right."""

    def __init__(self, text: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while text[at:].strip():
            m = _TOKENS.match(text, at)
            if m is None:
                if re.fullmatch(r"\s*#[^\n]*\s*", text[at:]):
                    break
                raise ValueError(f"not understood: {text[at : at + 30]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def next(self) -> tuple[str, str]:
        token = self.peek()
        self.at += 1
        return token

    def takes(self, *words: str) -> bool:
        """Whether the next token is one of these words or signs; takes it if so."""
        kind, text = self.peek()
        if kind in ("name", "op") and text.upper() in words:
            self.at += 1
            return True
        return False

    def must(self, word: str) -> None:
        if not self.takes(word):
            raise ValueError(f"{word} expected, not {self.peek()[1]!r}")

    def number(self) -> int:
        kind, text = self.next()
        if kind != "number" or not text.isdigit():
            raise ValueError(f"a whole number expected, not {text!r}")
        return int(text)

    def term(self) -> str:
        """A term of a pattern; variables keep their question mark."""
        kind, text = self.next()
        if kind == "var":
            return "?" + text[1:]
        if kind == "iri":
            return text[1:-1]
        if kind == "string":
            return _literal(text)
        if kind == "number" or (kind == "name" and text.upper() not in _WORDS):
            return "rdf:type" if text == "a" else text
        raise ValueError(f"a term expected, not {text!r}")


def _literal(text: str) -> str:
    mark = text[0]
    inner = text[1 : text.rindex(mark)]
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m.group(1), m.group(1)), inner)


def parse(text: str) -> Sparql:
    """The query that a text spells; ValueError for what is not of the subset."""
    r = _Reader(text)
    while r.takes("PREFIX"):
        name = r.next()
        if name[0] != "name" or r.next()[0] != "iri":
            raise ValueError("a prefix needs a name and an IRI")
    kind, form = r.next()
    form = form.upper()
    if kind != "name" or form not in ("SELECT", "ASK", "CONSTRUCT", "DESCRIBE"):
        raise ValueError(f"SELECT, ASK, CONSTRUCT or DESCRIBE expected, not {form!r}")
    query = Sparql(form, Group())
    if form == "SELECT":
        query.distinct = r.takes("DISTINCT")
        if not r.takes("*"):
            while r.peek()[0] == "var":
                query.variables.append(r.next()[1][1:])
            if not query.variables:
                raise ValueError("no variable is selected")
    elif form == "CONSTRUCT":
        group = _group(r)
        if group.filters or group.optionals or group.unions or not group.patterns:
            raise ValueError("a template holds triples only")
        query.template = group.patterns
    elif form == "DESCRIBE":
        while r.peek()[0] in ("var", "iri", "name") and r.peek()[1].upper() != "WHERE":
            query.described.append(r.term())
        if not query.described:
            raise ValueError("nothing is described")
    needs_where = form != "DESCRIBE" or any(t.startswith("?") for t in query.described)
    if r.takes("WHERE") or r.peek() == ("op", "{"):
        query.where = _group(r)
    elif needs_where:
        raise ValueError("a group of patterns expected")
    if needs_where and not (query.where.patterns or query.where.unions):
        raise ValueError("no triple pattern")
    while r.peek()[0] != "end":
        if r.takes("ORDER"):
            r.must("BY")
            while True:
                down = r.takes("DESC")
                if down or r.takes("ASC"):
                    r.must("(")
                    kind, name = r.next()
                    r.must(")")
                elif r.peek()[0] == "var":
                    kind, name = r.next()
                else:
                    break
                if kind != "var":
                    raise ValueError(f"only variables can be ordered by, not {name!r}")
                query.order.append((name[1:], down))
            if not query.order:
                raise ValueError("ORDER BY needs a variable")
        elif r.takes("LIMIT"):
            query.limit = r.number()
        elif r.takes("OFFSET"):
            query.offset = r.number()
        else:
            raise ValueError(f"not understood: {r.peek()[1]!r}")
    return query


def _group(r: _Reader) -> Group:
    r.must("{")
    group = Group()
    while not r.takes("}"):
        if r.peek()[0] == "end":
            raise ValueError("a group is not closed")
        if r.takes("FILTER"):
            if r.peek() == ("op", "("):
                r.must("(")
                group.filters.append(_either(r))
                r.must(")")
            else:
                group.filters.append(_operand(r))
        elif r.takes("OPTIONAL"):
            group.optionals.append(_group(r))
        elif group.optionals:
            raise ValueError("what must match stands before OPTIONAL")
        elif r.peek() == ("op", "{"):
            branches = [_group(r)]
            while r.takes("UNION"):
                branches.append(_group(r))
            group.unions.append(branches)
        else:
            _triples(r, group.patterns)
            if r.peek() not in (("op", "}"), ("op", ".")) and r.peek()[1].upper() not in ("FILTER", "OPTIONAL") and r.peek() != ("op", "{"):
                raise ValueError(f"the end of a pattern expected, not {r.peek()[1]!r}")
        while r.takes("."):
            pass
    return group


def _triples(r: _Reader, patterns: list[Pattern]) -> None:
    subject = r.term()
    while True:
        predicate = r.term()
        while True:
            patterns.append((subject, predicate, r.term()))
            if not r.takes(","):
                break
        if not r.takes(";"):
            return


def _either(r: _Reader) -> tuple:
    out = _both(r)
    while r.takes("||"):
        out = ("or", out, _both(r))
    return out


def _both(r: _Reader) -> tuple:
    out = _comparison(r)
    while r.takes("&&"):
        out = ("and", out, _comparison(r))
    return out


def _comparison(r: _Reader) -> tuple:
    left = _operand(r)
    kind, sign = r.peek()
    if kind == "op" and sign in ("=", "!=", "<", "<=", ">", ">="):
        r.next()
        return ("compare", sign, left, _operand(r))
    return left


def _operand(r: _Reader) -> tuple:
    if r.takes("!"):
        return ("not", _operand(r))
    if r.takes("("):
        out = _either(r)
        r.must(")")
        return out
    kind, text = r.next()
    if kind == "var":
        return ("var", text[1:])
    if kind == "string":
        return ("text", _literal(text))
    if kind == "number":
        return ("number", float(text))
    if kind == "iri":
        return ("text", text[1:-1])
    if kind == "name" and text.upper() in _FUNCTIONS and r.takes("("):
        name, given = text.upper(), [_either(r)]
        while r.takes(","):
            given.append(_either(r))
        r.must(")")
        if len(given) != _FUNCTIONS[name] and not (name == "REGEX" and len(given) == 3):
            raise ValueError(f"{name} takes {_FUNCTIONS[name]} arguments")
        return ("call", name, given)
    if kind == "name" and text.upper() not in _WORDS:
        return ("text", text)
    raise ValueError(f"not understood in a filter: {text!r}")


def _variables(e: tuple | list) -> set[str]:
    if isinstance(e, tuple) and e[0] == "var":
        return {e[1]}
    return {v for x in e if isinstance(x, (tuple, list)) for v in _variables(x)}


def _column(e: tuple) -> Column:
    """A filter expression over columns named as the variables."""
    kind = e[0]
    if kind == "var":
        return F.col(e[1])
    if kind in ("text", "number"):
        return F.lit(e[1])
    if kind == "not":
        return ~_column(e[1])
    if kind in ("and", "or"):
        a, b = _column(e[1]), _column(e[2])
        return a & b if kind == "and" else a | b
    if kind == "compare":
        _, sign, left, right = e
        a, b = _column(left), _column(right)
        # Numbers are compared as numbers, whatever the table holds; what is none is left out.
        if "number" in (left[0], right[0]) or (sign not in ("=", "!=") and "text" not in (left[0], right[0])):
            a, b = a.try_cast("double"), b.try_cast("double")
        return {"=": a == b, "!=": a != b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[sign]
    _, name, given = e
    if name == "BOUND":
        if given[0][0] != "var":
            raise ValueError("BOUND takes a variable")
        return F.col(given[0][1]).isNotNull()
    if name == "REGEX":
        if any(g[0] != "text" for g in given[1:]) or (len(given) == 3 and given[2][1] != "i"):
            raise ValueError("REGEX takes a pattern and the flag i as literals")
        return _column(given[0]).rlike(("(?i)" if len(given) == 3 else "") + given[1][1])
    values = [_column(g) for g in given]
    return {"CONTAINS": F.contains, "STRSTARTS": F.startswith, "STRENDS": F.endswith, "LCASE": F.lower, "UCASE": F.upper, "STR": lambda c: c, "STRLEN": F.length}[name](*values)


@dataclass
class Bindings:
    """Solutions with a column a variable; those in ``loose`` may be null."""

    rows: DataFrame
    loose: frozenset[str] = frozenset()


def _join(left: Bindings, right: Bindings, how: str) -> Bindings:
    shared = sorted(set(left.rows.columns) & set(right.rows.columns))
    if not shared:
        raise ValueError("parts of the query have no variable in common, so every combination would be a solution")
    if unsure := set(shared) & (left.loose | right.loose):
        raise ValueError(f"?{min(unsure)} may be unbound where it joins parts of the query")
    loose = left.loose | right.loose
    if how == "left":
        loose |= set(right.rows.columns) - set(shared)
    return Bindings(left.rows.join(right.rows, shared, how), frozenset(loose))


def solve(triples: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """The bindings of a basic graph pattern; terms that begin with ``?`` are variables. Joins are on shared variables.

    Patterns are taken in an order in which each shares a variable with those
    before; patterns that share none raise ValueError, since every combination
    would be a solution.
    """
    ground = [p for p in patterns if not any(t.startswith("?") for t in p)]
    left, out = [p for p in patterns if p not in ground], None
    while left:
        known = set(out.columns) if out is not None else set()
        pattern = next((p for p in left if out is None or known & {t[1:] for t in p if t.startswith("?")}), None)
        if pattern is None:
            raise ValueError("the patterns have no variable in common")
        left.remove(pattern)
        rows, names = triples, {}
        for column, term in zip(("subject", "predicate", "object"), pattern, strict=True):
            if term.startswith("?"):
                if term[1:] in names:
                    rows = rows.where(F.col(column) == F.col(names[term[1:]]))
                names.setdefault(term[1:], column)
            else:
                rows = rows.where(F.col(column) == term)
        bound = rows.select(*(F.col(c).alias(n) for n, c in names.items())).distinct()
        out = bound if out is None else out.join(bound, sorted(known & set(names)))
    # A pattern without variables is true or not.
    out = triples.sparkSession.range(1).select(F.lit(True).alias("_")) if out is None else out
    for subject, predicate, object_ in ground:
        there = triples.where((F.col("subject") == subject) & (F.col("predicate") == predicate) & (F.col("object") == object_)).limit(1)
        out = out.where(there.agg(F.count("*")).scalar() > 0)
    return out


def _solutions(triples: DataFrame, group: Group) -> Bindings:
    out = Bindings(solve(triples, group.patterns)) if group.patterns else None
    for branches in group.unions:
        parts = [_solutions(triples, b) for b in branches]
        names = set().union(*(p.rows.columns for p in parts))
        loose = frozenset().union(*(p.loose | (names - set(p.rows.columns)) for p in parts))
        union = Bindings(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.rows for p in parts]), loose)
        out = union if out is None else _join(out, union, "inner")
    if out is None:
        raise ValueError("a group needs a triple pattern")
    for optional in group.optionals:
        out = _join(out, _solutions(triples, optional), "left")
    for condition in group.filters:
        if missing := _variables(condition) - set(out.rows.columns):
            raise ValueError(f"?{min(missing)} of a filter is not in its group")
        out = Bindings(out.rows.where(_column(condition)), out.loose)
    return out


def run(triples: DataFrame, text: str) -> DataFrame:
    """The result of a query: the selected variables, for ASK one row ``answer``, for CONSTRUCT and DESCRIBE triples.

    DESCRIBE gives the triples with a described term as subject or object.
    LIMIT and OFFSET without ORDER BY take the rows in the order of all columns.
    """
    query = parse(text)
    rows = _solutions(triples, query.where).rows if query.where.patterns or query.where.unions else None
    if query.form == "ASK":
        return rows.limit(1).agg((F.count("*") > 0).alias("answer"))
    known = set(rows.columns) if rows is not None else set()
    asked = [*query.variables, *(v for v, _ in query.order), *(t[1:] for p in query.template for t in p if t.startswith("?")), *(t[1:] for t in query.described if t.startswith("?"))]
    if missing := set(asked) - known:
        raise ValueError(f"?{min(missing)} is in no pattern")
    if query.form == "SELECT":
        names = query.variables or sorted(known)
        if query.distinct:
            if extra := {v for v, _ in query.order} - set(names):
                raise ValueError(f"?{min(extra)} is ordered by but not among the distinct variables")
            rows = rows.select(*names).distinct()
        return _cut(rows, query, names).select(*names)
    if query.form == "CONSTRUCT":
        rows = _cut(rows, query, sorted(known))
        value = lambda t: F.col(t[1:]) if t.startswith("?") else F.lit(t)
        listed = F.array(*(F.struct(*(value(t).alias(c) for t, c in zip(p, ("subject", "predicate", "object"), strict=True))) for p in query.template))
        made = rows.select(F.explode(listed).alias("t")).select("t.*")
        return made.where("subject IS NOT NULL AND predicate IS NOT NULL AND object IS NOT NULL").distinct()
    terms = triples.sparkSession.createDataFrame([(t,) for t in query.described if not t.startswith("?")], "term string")
    for name in (t[1:] for t in query.described if t.startswith("?")):
        terms = terms.unionByName(_cut(rows, query, sorted(known)).select(F.col(name).alias("term")))
    terms = terms.where("term IS NOT NULL").distinct()
    return triples.join(terms.withColumnRenamed("term", "subject"), "subject", "left_semi").unionByName(triples.join(terms.withColumnRenamed("term", "object"), "object", "left_semi")).select("subject", "predicate", "object").distinct()


def _cut(rows: DataFrame, query: Sparql, names: list[str]) -> DataFrame:
    if query.order or query.limit is not None or query.offset:
        first = [F.desc(v) if down else F.asc(v) for v, down in query.order]
        rows = rows.orderBy(*first, *(n for n in names if n not in {v for v, _ in query.order}))
    if query.offset:
        rows = rows.offset(query.offset)
    return rows if query.limit is None else rows.limit(query.limit)
