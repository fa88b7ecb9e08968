"""Personal data: fixed patterns, and candidates judged by weak supervision."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, let, running, stage, thin, with_text
from .quality import VoteModel, fit_votes

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LOCAL = r"[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds matches from the left, ``needs`` is a cheap test of the text."""

    name: str
    pattern: str
    needs: str


#: Fixed kinds in the order of the contract. Look-behinds and possessive repeats
#: change no match; they keep long runs of one class linear. ``\G`` lets a match
#: begin where the one before it ended.
BASE = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    # a whole run of 14 to 19 digits with single separators
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])", ""),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)

#: Given names that are hardly ever another word.
GIVEN_NAMES = (
    "Adam|Alan|Albert|Alejandro|Alexander|Alfred|Alice|Alicia|Amelia|Ana|Andrea|Andreas|Andrew|Angela|Anja|"
    "Anna|Anne|Antoine|Antonio|Barbara|Beatriz|Benjamin|Bernard|Birgit|Brigitte|Camille|Carla|Carlos|Carmen|"
    "Caroline|Catherine|Charles|Charlotte|Christian|Christine|Christopher|Claire|Claudia|Cristina|Daniel|"
    "David|Deborah|Diego|Dieter|Dorothy|Edward|Elena|Elisabeth|Elizabeth|Emily|Emma|Enrique|Eric|Esther|Eva|"
    "Felix|Fernando|Francisco|Franz|Gabriel|Georg|George|Gerhard|Hannah|Hans|Heinrich|Helen|Helga|Henri|Henry|"
    "Ingrid|Isabel|Isabelle|James|Janet|Javier|Jean|Jennifer|Jessica|Johann|John|Jonathan|Jorge|Jose|Joseph|"
    "Juan|Julia|Julien|Karin|Karl|Katharina|Katherine|Kevin|Klaus|Laura|Laurent|Linda|Lisa|Louis|Louise|Lucas|"
    "Lucia|Luis|Manuel|Marcel|Margaret|Maria|Marie|Marta|Martin|Martina|Mary|Mathieu|Matthew|Michael|Michel|"
    "Miguel|Monika|Nancy|Nathalie|Nicolas|Olivier|Pablo|Patricia|Paul|Pedro|Peter|Philippe|Pierre|Rachel|Raquel|"
    "Rebecca|Renate|Richard|Robert|Rosa|Ruth|Sabine|Samuel|Sandra|Sarah|Sergio|Simon|Sofia|Stefan|Stephen|"
    "Susan|Susanne|Teresa|Thomas|Ursula|Valerie|Victor|Virginia|Walter|Werner|William|Wolfgang|Yvonne"
)
#: Given names that are months, verbs or common words as well.
DOUBTFUL_NAMES = (
    "April|Art|August|Bill|Bob|Chase|Claude|Dawn|Drew|Frank|Grace|Grant|Hope|Jack|Jan|Jose|Joy|June|Lance|Marc|"
    "Mark|Max|May|Pat|Rob|Rose|Sue|Summer|Will"
)
_TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Madame|Monsieur)"
#: A word with a capital, or several with hyphens.
_CAPITAL = r"\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)*+"

_EDGE, _END = r"(?<![\p{L}\p{N}_-])", r"(?![\p{L}\p{N}_-])"
#: Further kinds: a match is only a candidate.
CANDIDATES = (
    Kind("ssn", rf"{_EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_END}", ""),
    Kind("iban", rf"{_EDGE}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}", ""),
    Kind("local_phone", rf"{_EDGE}(?:\([0-9]{{2,4}}\)|[0-9]{{2,4}})[ .-][0-9]{{3,4}}[ .-][0-9]{{3,4}}{_END}", ""),
    Kind("secret", rf"{_EDGE}(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{{16,}}+{_END}", ""),
    Kind(
        "name",
        rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLE}\.? {_CAPITAL}|(?:{GIVEN_NAMES}|{DOUBTFUL_NAMES})(?!\p{{L}})(?:-\p{{Lu}}\p{{Ll}}++)*+)"
        rf"(?: {_CAPITAL})?(?!\p{{L}})",
        "",
    ),
)
KINDS = tuple(k.name for k in (*BASE, *CANDIDATES))

#: Words before a value that say it is personal or secret, or that it is not.
TELLING = (
    r"(?i)(passw(or)?d|passwort|contraseña|mot de passe|pwd|token|secret|api[_ -]?key|access[_ -]?key|"
    r"credential|private key|ssn|social security|iban|account|konto|cuenta|compte|phone|tel|mobile|"
    r"fax|call|telefon|teléfono|téléphone)[\s\"'=:#.>-]{0,6}$"
)
INNOCENT = (
    r"(?i)(sha-?1|sha-?256|md5|commit|checksum|hash|digest|revision|version|build|isbn|issn|doi|"
    r"page|figure|table|chapter|uuid|article|item|order|invoice)[\s\"'=:#.>-]{0,6}$"
)
#: Beginnings of keys that services hand out.
KEY_STARTS = r"^(AKIA|ASIA|AIza|ghp_|gho_|ghs_|glpat-|xox[bpa]-|sk[-_]|pk_|rk_|eyJ|ya29)"

#: What makes of a capitalised word a person, and what does not.
_ANNOUNCED = r"(?i)\b(name|contact|dear|attn|from|by|sir|madam|signed|liebe[r]?|hola|bonjour|cher|chère|author)[\s:,]{1,3}$"
_FOLLOWS = r"^(?:'s\b| ?[0-9%$€]|[/_=(]| (?:the|a|an|is|it|to|of|up|down|out|all|your|this|that|these|those|not|be|have)\b)"
_TITLED, _PAIR = rf"c.m rlike '^{_TITLE}[.]? '", f"c.m rlike '^({GIVEN_NAMES}|{DOUBTFUL_NAMES})(-[^ ]+)? '"
_SURE = f"c.m rlike '^({GIVEN_NAMES})($|[ -])'"
_WORD = "c.kind = 'name' and not (c.m rlike ' ')"
#: A name by its form: 1 a title, 2 a sure and 3 a doubtful given name and another word, 4 and 5 such a given name alone.
_FORM = (
    f"case when c.kind != 'name' then 0 when {_TITLED} then 1 when {_PAIR} and {_SURE} then 2 when {_PAIR} then 3 "
    f"when {_SURE} then 4 else 5 end"
)
_OPENS = "c.before rlike '(^|[.!?\\n])[\"»”)]?[ \\n]*$'"
_SAID, _DENIED = f"c.before rlike r'{_ANNOUNCED}'", f"c.after rlike r\"{_FOLLOWS}\""

#: Regex, gazetteer and context labelers: SQL on a candidate ``c`` (kind, m, before, after, lower).
LABELERS = (
    ("context", f"c.before rlike r'{TELLING}' or (c.kind = 'name' and {_SAID})".replace("\"'", "\"\\x27"),
     f"c.before rlike r'{INNOCENT}' or (c.kind = 'name' and {_DENIED})".replace("\"'", "\"\\x27")),
    ("gazetteer", f"(c.kind = 'secret' and c.m rlike '{KEY_STARTS}') or (c.kind = 'name' and ({_TITLED} or ({_PAIR} and {_SURE})))",
     # a given name alone, or one that the text has in lower case too, may be any word
     f"{_WORD} or (c.kind = 'name' and c.lower and not {_TITLED})"),
    ("shape",
     "(c.kind = 'secret' and c.m rlike '^([a-f0-9]{16,}|[A-Z0-9]{16,}|(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9].*[0-9]).{20,})$')"
     " or (c.kind = 'ssn' and not c.m rlike '^(000|666|9)')"
     " or (c.kind = 'iban' and c.m rlike '^(AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PT)')"
     " or (c.kind = 'local_phone' and c.m rlike '^[(]?0|[)]')",
     f"({_WORD} and {_OPENS}) or ({_FORM} in (3, 5) and {_OPENS})"
     " or (c.kind = 'secret' and c.m rlike '^[A-Za-z]+([_-][A-Za-z]++)*+[_-]?[0-9]{1,4}$')"
     " or (c.kind = 'ssn' and c.m rlike '^(000|666)|-00-|-0000$')"),
    ("variety", "size(array_distinct(split(c.m, ''))) >= 9 and c.kind in ('secret', 'iban')",
     "size(array_distinct(split(c.m, ''))) <= 4 and c.kind != 'name'"),
    ("assigned", "c.before rlike '[=:][ \"]{0,3}$'", "false"),
    ("numbers", "c.kind in ('ssn', 'local_phone') and not c.before rlike '[0-9.,/][ ]?$'",
     "c.kind in ('ssn', 'local_phone') and c.before rlike '[0-9.,/][ ]?$'"),
)

#: So many of them, the first ones, vote on names.
NAME_LABELERS = 3

#: Features of the span classifier, each a small whole number.
FEATURES = (
    "cast(array_position(array('ssn','iban','local_phone','secret','name'), c.kind) as int)",
    "case when length(c.m) < 18 then 0 when length(c.m) < 24 then 1 when length(c.m) < 48 then 2 else 3 end",
    "cast(least(3, floor(4 * length(regexp_replace(c.m, '[^0-9]', '')) / length(c.m))) as int)",
    "case when c.m rlike '[a-z]' then 1 else 0 end + case when c.m rlike '[A-Z]' then 2 else 0 end",
    "case when c.before rlike '[=:\"]$' then 2 when c.before rlike '[A-Za-z][ =:\"]{1,4}$' then 1 else 0 end",
    _FORM,
    f"case when c.kind != 'name' then 0 when c.lower or {_DENIED} then 1 when {_SAID} then 2 when {_OPENS} then 3 else 4 end",
)
#: Context kept with a candidate, in code points.
BEFORE, AFTER = 32, 16
#: Code points from which on a text is cut into blocks of so many, to find places in it.
CUT = 8192

_SPAN = "struct<s:int,k:int,e:int,kind:string,m:string>"


def _none(kind: str = _SPAN) -> Column:
    return F.expr("array()").cast(f"array<{kind}>")


def _matches(rows: DataFrame, kinds: dict[str, Kind]) -> DataFrame:
    """``rows`` with ``f_<name>``: matches as ``s, e, m`` in code points, from the left.

    The matches and the text between them come from the same pattern; their
    lengths, added up, are the positions.
    """
    text = F.col("text")
    found = {
        f"f_{name}": F.when(
            F.contains(text, F.lit(k.needs)) if k.needs else F.lit(True),
            F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)),
        ).otherwise(F.expr("array()").cast("array<string>"))
        for name, k in kinds.items()
    }
    rows = rows.withColumns(found)
    gaps = {
        f"g_{name}": F.when(F.size(f"f_{name}") > 0, F.split(text, k.pattern, -1))
        for name, k in kinds.items()
    }
    rows = rows.withColumns(gaps)
    placed = {}
    for name in kinds:
        m, g = F.col(f"f_{name}"), F.col(f"g_{name}")
        parts = F.zip_with(
            m, F.slice(g, 1, F.size(m)),
            lambda a, b: F.struct(a.alias("m"), F.length(a).alias("n"), (F.length(a) + F.length(b)).alias("step")),
        )
        found = let(
            parts,
            lambda p: F.zip_with(
                p,
                running(F.transform(p, lambda x: x["step"]), "int", lambda a, b: a + b),
                lambda x, e: F.struct((e - x["n"]).alias("s"), e.alias("e"), x["m"].alias("m")),
            ),
        )
        placed[f"f_{name}"] = F.when(F.size(m) > 0, found).otherwise(
            F.expr("array()").cast("array<struct<s:int,e:int,m:string>>")
        )
    return rows.withColumns(placed).drop(*gaps)


def _blocks(text: Column) -> Column:
    """The text in blocks of ``CUT`` code points; one that is short or long alike."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return F.when(F.length(text) <= CUT, F.array(text)).otherwise(cut)


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` to before ``end``, read in the blocks that hold them only."""
    first, last = F.floor(start / CUT).cast("int"), F.floor((end - 1) / CUT).cast("int")
    parts = F.transform(
        F.sequence(first, F.greatest(first, last)),
        lambda k: F.substr(
            F.get(blocks, k),
            F.greatest(start - k * CUT, F.lit(0)) + 1,
            F.least(end - k * CUT, F.lit(CUT)) - F.greatest(start - k * CUT, F.lit(0)),
        ),
    )
    return F.when(end > start, F.array_join(parts, "")).otherwise("")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + F.when(i % 2 == 1, F.substr(back, i, F.lit(1)).cast("int")).otherwise(
            (F.substr(back, i, F.lit(1)).cast("int") * 2) % 10
            + F.floor(F.substr(back, i, F.lit(1)).cast("int") / 5).cast("int")
        ),
    )
    return total % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


_VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": lambda m: _luhn(_digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
}


def _named(spans: Column, name: str) -> Column:
    return F.transform(
        spans,
        lambda x: F.struct(
            x["s"].alias("s"), F.lit(KINDS.index(name)).alias("k"), x["e"].alias("e"),
            F.lit(name).alias("kind"), x["m"].alias("m"),
        ),
    )


def found_spans(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``) and ``base``, ``candidates``: sorted arrays of spans.

    Candidates that overlap a base span are left out; each has the text before it.
    """
    one = "|".join(f"(?:{k.pattern})" for k in CANDIDATES)
    kinds = {k.name: k for k in BASE} | {"any": Kind("any", one, "")}
    others = rows.columns
    rows = _matches(rows, kinds)
    base = [
        _named(F.filter(f"f_{k.name}", lambda x: _VALID[k.name](x["m"])), k.name) for k in BASE
    ]
    rows = rows.select(*others, "f_any", F.sort_array(F.flatten(F.array(*base))).alias("base"))

    def kind_of(m):
        kind = F.lit(CANDIDATES[-1].name)
        for k in reversed(CANDIDATES[:-1]):
            kind = F.when(m.rlike(f"^(?:{k.pattern})$"), F.lit(k.name)).otherwise(kind)
        return kind

    def described(c, text):
        start, end = F.greatest(c["s"] - BEFORE, F.lit(0)), F.least(c["e"] + AFTER, text["n"])
        return F.struct(
            c["s"].alias("s"), c["e"].alias("e"), kind_of(c["m"]).alias("kind"), c["m"].alias("m"),
            _between(text["blocks"], start, c["s"]).alias("before"),
            _between(text["blocks"], c["e"], end).alias("after"),
            F.array_contains(text["lower"], F.lower(F.element_at(F.split(c["m"], " "), 1))).alias("lower"),
        )

    text = F.struct(
        _blocks(F.col("text")).alias("blocks"), F.length("text").alias("n"), _lone_words(F.col("text")).alias("lower")
    )
    found = F.when(
        F.size("f_any") > 0,
        let(text, lambda t: F.transform(_apart("f_any", "base"), lambda c: described(c, t))),
    )
    none = F.expr("array()").cast(
        "array<struct<s:int,e:int,kind:string,m:string,before:string,after:string,lower:boolean>>"
    )
    return rows.select(*others, "base", F.coalesce(found, none).alias("candidates"))


_LONE = rf"(?<!\p{{L}})(?:{GIVEN_NAMES}|{DOUBTFUL_NAMES})(?!\p{{L}})".lower().replace("\\p{l}", "\\p{L}")


def _lone_words(text: Column) -> Column:
    """Given names of the gazetteer that the text has in lower case."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_LONE), F.lit(0)))


def _apart(found: str, base: str) -> Column:
    """The matches that no base span overlaps.

    Few are compared with each other. Else both are sorted by start: a match is apart if no
    base span before it ends behind its start and the next one starts behind its end.
    """
    few = F.filter(found, lambda c: ~F.exists(base, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
    never = (1 << 31) - 1

    def event(x, is_base):
        return F.struct(x["s"].alias("s"), F.lit(is_base).alias("k"), x["e"].alias("e"), x["m"].alias("m"))

    both = F.sort_array(
        F.concat(F.transform(base, lambda b: event(b, 0)), F.transform(found, lambda c: event(c, 1)))
    )

    def scanned(x):
        ends = running(
            F.transform(x, lambda y: F.when(y["k"] == 0, y["e"]).otherwise(0)), "int", lambda a, b: F.greatest(a, b)
        )
        starts = F.reverse(
            running(
                F.transform(F.reverse(x), lambda y: F.when(y["k"] == 0, y["s"]).otherwise(never)),
                "int", lambda a, b: F.least(a, b), never,
            )
        )
        kept = F.zip_with(
            F.zip_with(x, ends, lambda y, e: F.struct(y.alias("y"), e.alias("end"))),
            starts,
            lambda p, s: F.when(
                (p["y"]["k"] == 1) & (p["end"] <= p["y"]["s"]) & (s >= p["y"]["e"]),
                F.struct(p["y"]["s"].alias("s"), p["y"]["e"].alias("e"), p["y"]["m"].alias("m")),
            ),
        )
        return F.filter(kept, lambda y: y.isNotNull())

    return F.when(F.greatest(F.size(found), F.size(base)) <= 64, few).otherwise(let(both, scanned))


def _votes(c: str = "c") -> list[Column]:
    return [
        F.expr(f"cast(case when {bad} then -1 when {good} then 1 else 0 end as int)")
        for _, good, bad in LABELERS
    ]


@dataclass(frozen=True)
class SpanModel:
    """Labeler weights, and the classifier's weight for each value of each feature."""

    votes: VoteModel
    bias: float
    weights: tuple[dict[int, float], ...]

    def log_odds(self, features) -> float:
        return self.bias + sum(w.get(v, 0.0) for w, v in zip(self.weights, features))


def fit_spans(patterns: dict[tuple, int], n: int = len(LABELERS), rounds: int = 400) -> SpanModel:
    """Fit both models on counts of (``n`` votes, features).

    Expectation-maximisation over the votes gives each pattern a chance of being
    personal. A logistic regression on the features learns these chances, by
    gradient steps from zero with a small penalty. No patterns: no weight, so
    no candidate is accepted.
    """
    by_votes: dict[tuple, int] = {}
    for key, count in patterns.items():
        by_votes[key[:n]] = by_votes.get(key[:n], 0) + count
    votes = fit_votes(by_votes, n, share=0.5)
    total = sum(patterns.values())
    rows = [
        (key[n:], count / total, 1 / (1 + math.exp(-max(-500.0, votes.log_odds(key[:n])))))
        for key, count in sorted(patterns.items())
    ]
    bias, weights = 0.0, [{} for _ in FEATURES]
    for _ in range(rounds):
        slope, slopes = 0.0, [{} for _ in FEATURES]
        for features, share, target in rows:
            z = bias + sum(w.get(v, 0.0) for w, v in zip(weights, features))
            error = share * (1 / (1 + math.exp(-max(-500.0, z))) - target)
            slope += error
            for g, v in zip(slopes, features):
                g[v] = g.get(v, 0.0) + error
        bias -= 2.0 * slope
        for w, g in zip(weights, slopes):
            for v, d in g.items():
                w[v] = w.get(v, 0.0) * 0.999 - 2.0 * d
    return SpanModel(votes, bias if rows else -1.0, tuple(weights))


def span_models(found: DataFrame) -> tuple[SpanModel, SpanModel]:
    """Models of names and of all other kinds, fitted on all candidates.

    Hardly a labeler votes on both alike, so each has reliabilities of its own. The driver gets one
    number per pattern of votes and features, of which there are at most
    ``3 ** labelers * 5 * 4 ** 3 * 3 * 6 * 5``.
    """
    votes, features = _votes(), [F.expr(f).cast("int") for f in FEATURES]
    names = [f"p{k}" for k in range(len(votes) + len(features))]
    counted = (
        found.select(F.explode("candidates").alias("c"))
        .select(*[x.alias(n) for x, n in zip([*votes, *features], names)])
        .groupBy(*names).count()
    )
    of_names: dict[tuple, int] = {}
    others: dict[tuple, int] = {}
    for r in counted.collect():
        key = tuple(r[n] for n in names)
        if key[len(votes)] == len(CANDIDATES):  # a name
            key = key[:NAME_LABELERS] + key[len(votes) :]
            of_names[key] = of_names.get(key, 0) + r["count"]
        else:
            others[key] = r["count"]
    return fit_spans(of_names, NAME_LABELERS), fit_spans(others)


def accepted(models: tuple[SpanModel, SpanModel]) -> Column:
    """Candidates that their classifier finds more likely personal than not."""

    def odds(model):
        parts = [f"{model.bias!r}D"]
        for feature, weights in zip(FEATURES, model.weights):
            if weights:
                cases = " ".join(f"when {v} then {w!r}D" for v, w in sorted(weights.items()))
                parts.append(f"case {feature} {cases} else 0D end")
        return " + ".join(parts)

    order = ", ".join(f"'{k}'" for k in KINDS)
    names, others = models
    return F.expr(
        f"transform(filter(candidates, c -> case when c.kind = 'name' then {odds(names)} else {odds(others)} end > 0D), "
        f"c -> struct(c.s as s, cast(array_position(array({order}), c.kind) - 1 as int) as k, "
        f"c.e as e, c.kind as kind, c.m as m))"
    )


def with_spans(found: DataFrame, label: str) -> DataFrame:
    """Write the rows of ``found_spans``; ``spans`` then has base and accepted ones, sorted."""
    found = stage(found, label)
    models = span_models(found)
    both = F.sort_array(F.concat("base", accepted(models).cast(f"array<{_SPAN}>")))
    return found.withColumn("spans", both).drop("candidates")


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, base, spans``.

    Spans are structs ``s, k, e, kind, m``: start, place of the kind, end
    (exclusive, code points), kind and text, sorted by start and kind. ``base``
    has the fixed kinds, ``spans`` also the accepted candidates. A null or empty
    text has none. Repeated rows stay, an empty table gives an empty result,
    other columns are ignored.
    """
    return with_spans(found_spans(thin(df, id_col, text_col)).drop("text"), "spans")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(
        F.transform(
            spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))
        ),
        ",",
    )


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with every span replaced by its kind, such as ``[EMAIL]``.

    A span that begins inside one already replaced adds nothing but its rest,
    which is removed. A column ``n_chars`` follows the text. A null text becomes
    empty.
    """
    found = with_spans(found_spans(boxed(df, id_col, text_col).select("row", "text")), "redact")
    text = F.col("text")

    def cleaned(blocks):
        reached = running(F.transform("spans", lambda x: x["e"]), "int", lambda a, b: F.greatest(a, b))
        parts = let(
            reached,
            lambda ends: F.concat(
                F.transform(
                    "spans",
                    lambda x, i: let(
                        F.coalesce(F.get(ends, i - 1), F.lit(0)),
                        lambda at: F.when(
                            x["s"] >= at,
                            F.concat(_between(blocks, at, x["s"]), F.lit("["), F.upper(x["kind"]), F.lit("]")),
                        ).otherwise(""),
                    ),
                ),
                F.array(_between(blocks, F.element_at(ends, -1), F.length(text))),
            ),
        )
        return F.array_join(parts, "")

    clean = F.when(F.size("spans") > 0, let(_blocks(text), cleaned)).otherwise(text)
    found = found.withColumn("clean", clean)
    return with_text(found, df.columns, text_col, F.col("clean"))
