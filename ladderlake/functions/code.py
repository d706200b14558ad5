"""Column functions on source text of control programs and on model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Block keywords that the older rules count against each other, in their order.
LEGACY_PAIRS = {
    "IF": "END_IF",
    "CASE": "END_CASE",
    "FOR": "END_FOR",
    "WHILE": "END_WHILE",
    "REPEAT": "UNTIL",
    "FUNCTION_BLOCK": "END_FUNCTION_BLOCK",
    "VAR": "END_VAR",
    "VAR_INPUT": "END_VAR",
    "VAR_OUTPUT": "END_VAR",
}
#: Keywords that open and close blocks in well-formed programs; every kind of VAR section closes with END_VAR.
PAIRS = {
    "IF": "END_IF",
    "CASE": "END_CASE",
    "FOR": "END_FOR",
    "WHILE": "END_WHILE",
    "REPEAT": "END_REPEAT",
    "FUNCTION_BLOCK": "END_FUNCTION_BLOCK",
    "VAR(?:_INPUT|_OUTPUT|_IN_OUT|_TEMP|_GLOBAL|_EXTERNAL)?": "END_VAR",
}
#: Words of a provider's error that rule a key out for good.
FATAL_WORDS = ["401", "unauthorized", "invalid api key", "incorrect api key", "invalid_api_key", "insufficient", "quota", "balance", "arrears", "suspended"]
#: Words of errors that pass by waiting.
RATE_LIMIT_WORDS = ["429", "rate limit", "too many requests", "rpm limit exceeded", "please complete identity verification", "403"]
#: Words of errors that need a whole minute.
MINUTE_WORDS = ["rpm", "403", "identity verification"]
#: Keywords that a block must hold. Fixed values.
REQUIRED = ["FUNCTION_BLOCK", "END_FUNCTION_BLOCK", "VAR", "END_VAR"]
COMMENT = r"(?s)\(\*.*?\*\)|//[^\n]*"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def auto_repair(code: Column) -> Column:
    """The first fenced block, or the text, stripped; empty if it begins like another language."""
    fenced = code.rlike(r"(?s)```[a-zA-Z]*\n.*?```")
    body = stripped(F.when(fenced, F.regexp_extract(code, r"(?s)```[a-zA-Z]*\n(.*?)```", 1)).otherwise(code))
    return F.when(F.coalesce(code, F.lit("")) == "", "").when(body.rlike(r"^(?i)(variables|import|def\s|class\s|#\s)"), "").otherwise(body)


def remove_comments(code: Column) -> Column:
    """Upper-cased, without comments outside of strings."""
    return F.upper(F.regexp_replace(code, r"(?s)('[^']*'|\"[^\"]*\")|//[^\r\n]*|\(\*.*?\*\)", "$1"))


def strip_comments(code: Column) -> Column:
    """Block comments go first, over line ends, then line comments."""
    return F.regexp_replace(F.regexp_replace(code, r"(?s)\(\*.*?\*\)", ""), r"//[^\n]*", "")


def clean_line(line: Column) -> Column:
    """Of one line: the line comment goes first, then block comments that end on it."""
    return F.regexp_replace(F.regexp_replace(line, r"//.*$", ""), r"\(\*.*?\*\)", "")


def norm_line(line: Column) -> Column:
    """Upper case, without comments and outer space."""
    return F.upper(stripped(strip_comments(line)))


def fast_validate(code: Column) -> Column:
    """Message of the first rule that fails, or Passed."""
    missing = ~F.contains(code, F.lit(REQUIRED[0]))
    for k in REQUIRED[1:]:
        missing = missing | ~F.contains(code, F.lit(k))
    return F.when(code.rlike(r"[\p{L}\p{N}_]\s*=\s*[\p{L}\p{N}_]+;"), "Illegal assignment '='").when(missing, "Missing structure keywords").when(F.upper(code).rlike(r"ARRAY ?\[\*\]"), "Dynamic arrays not supported").otherwise("Passed")


def two_keyword_validate(code: Column) -> Column:
    """The shortest rule set: no `=` as an assignment, and two keywords."""
    illegal = code.rlike(r"(?U)\b\w+\s*=\s*\w+;")
    missing = ~F.contains(code, F.lit("FUNCTION_BLOCK")) | ~F.contains(code, F.lit("END_VAR"))
    return F.when(illegal, "Illegal assignment '='").when(missing, "Missing keywords").otherwise("Passed")


def imbalance(code: Column, pairs: dict[str, str]) -> Column:
    """The first pair of block keywords whose counts differ, or null."""
    up = F.upper(code)
    out = F.lit(None).cast("string")
    for opens, closes in reversed(pairs.items()):
        x, y = F.regexp_count(up, F.lit(rf"\b{opens}\b")), F.regexp_count(up, F.lit(rf"\b{closes}\b"))
        name = opens.partition("(")[0]
        out = F.when(x != y, F.concat(F.lit(f"Structural imbalance: {name}("), x.cast("string"), F.lit(f") vs {closes}("), y.cast("string"), F.lit(")"))).otherwise(out)
    return out


def strict_validate(code: Column, legacy: bool = True) -> Column:
    """Message of the first rule that fails. legacy: as the older rules are, whose `//` takes the rest of the text and whose pairs include each kind of VAR section; otherwise with comments by line and PAIRS."""
    plain = F.regexp_replace(code, r"(?s)//.*|\(\*.*?\*\)", "") if legacy else strip_comments(code)
    wrong = imbalance(plain, LEGACY_PAIRS if legacy else PAIRS)
    up = F.upper(plain)
    missing = F.lit(False)
    for k in REQUIRED:
        missing = missing | ~F.contains(up, F.lit(k))
    return (
        F.when(plain.rlike(r"(?<![:<>])=(?!=)"), "Assignment Error: Found '=' instead of ':=' for assignment.")
        .when(wrong.isNotNull(), wrong)
        .when(missing, "Standard Structure Error: Missing FB or VAR declarations.")
        .otherwise("Passed All Strict Checks")
    )


def declared_vars(code: Column) -> Column:
    """Sorted distinct names declared in VAR blocks."""
    blocks = F.regexp_extract_all(code, F.lit(r"(?is)(VAR.*?END_VAR)"), F.lit(1))
    names = F.flatten(F.transform(blocks, lambda b: F.regexp_extract_all(b, F.lit(r"(\w+)\s*:\s*\w+"), F.lit(1))))
    return F.array_sort(F.array_distinct(names))


def used_vars(code: Column) -> Column:
    """Sorted distinct targets of assignments and simple right sides."""
    left = F.regexp_extract_all(code, F.lit(r"(\w+)\s*:=\s*\w+"), F.lit(1))
    right = F.filter(F.regexp_extract_all(code, F.lit(r"\w+\s*:=\s*(\w+)"), F.lit(1)), lambda x: x.rlike("^[A-Za-z_]"))
    return F.array_sort(F.array_distinct(F.concat(left, right)))


def clean_json(raw: Column) -> Column:
    """The JSON part of a model's reply: after its thoughts, without fences (those of other languages keep their word) and trailing commas; the object, else the list, that parses; else the span of whichever begins first, else all."""
    t = stripped(F.regexp_replace(F.substring_index(raw, "</think>", -1), r"(?i)```(?:json)?", ""))
    t = F.regexp_replace(F.regexp_replace(t, r",\s*\]", "]"), r",\s*\}", "}")
    both = lambda a, b: (F.locate(a, t) > 0) & (F.locate(b, t) > 0)
    # from the first opening to the last closing one; empty where they stand the other way round
    span = lambda a, b: F.when(both(a, b), t.substr(F.locate(a, t), F.greatest(F.length(t) - F.locate(b, F.reverse(t)) + 2 - F.locate(a, t), F.lit(0))))
    obj, arr = span("{", "}"), span("[", "]")
    first = obj.isNotNull() & ((F.locate("[", t) == 0) | (F.locate("{", t) < F.locate("[", t)))
    return F.when(F.try_parse_json(obj).isNotNull(), obj).when(F.try_parse_json(arr).isNotNull(), arr).when(first, obj).otherwise(F.coalesce(arr, t))


def clean_json_span(raw: Column) -> Column:
    """The older cleaner: without fences, the span from the first brace to the last, else of brackets, else empty."""
    t = stripped(F.regexp_replace(raw, r"(?i)```json|```", ""))
    has = lambda x: F.locate(x, t) > 0
    span = lambda a, b: t.substr(F.locate(a, t), F.greatest(F.length(t) - F.locate(b, F.reverse(t)) + 2 - F.locate(a, t), F.lit(0)))
    return F.when(has("{") & has("}"), span("{", "}")).when(has("[") & has("]"), span("[", "]")).otherwise("")


def task_key(instruction: Column) -> Column:
    return F.substring_index(instruction, "for: ", -1)


def tasks_of(reply: Column) -> Column:
    """Strings of over 10 characters in a model's JSON reply: of the list, or of an object's `tasks`, or, where these are missing or empty, of its first value."""
    as_list = lambda j: F.try_variant_get(F.try_parse_json(j), "$", "array<variant>")
    fields = F.from_json(reply, "map<string,string>")
    named = as_list(F.element_at(fields, F.lit("tasks")))
    first = as_list(F.element_at(F.map_values(fields), F.lit(1)))
    items = F.coalesce(as_list(reply), F.when(F.size(named) > 0, named), F.when(F.size(fields) > 0, first))
    strings = F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    return F.coalesce(F.filter(strings, lambda x: F.length(x) > 10), F.array().cast("array<string>"))


def _any_of(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def triage(message: Column) -> Column:
    """fatal, rate_limit or other, fatal words first."""
    m = F.lower(message)
    return F.when(_any_of(m, FATAL_WORDS), "fatal").when(_any_of(m, RATE_LIMIT_WORDS), "rate_limit").otherwise("other")


def wait_seconds(message: Column, attempt: Column) -> Column:
    """Of a rate limit: a minute, or three seconds more with each attempt (from 0)."""
    return F.when(triage(message) == "rate_limit", F.when(_any_of(F.lower(message), MINUTE_WORDS), 60).otherwise(3 * (attempt + 1))).cast("long")


#: Loops and branches that a line's head opens and an END_ word closes.
CONTROL = ["IF", "FOR", "CASE", "WHILE", "REPEAT"]


def head_of(line: Column, kind: str) -> Column:
    """Whether a cleaned line begins a structure of this kind; ELSIF begins none."""
    return line.rlike(rf"(?i)^\s*{kind}\b")


def ends_of(line: Column, kind: str) -> Column:
    return F.regexp_count(line, F.lit(rf"(?i)\bEND_{kind}\b"))


def ctrl_delta(line: Column) -> Column:
    """Structures that a line opens less those that it closes. A line opens at most one of each kind, at its beginning."""
    t = clean_line(line)
    delta = F.lit(0)
    for kind in CONTROL:
        at = F.regexp_replace(t, r"(?i)\bELSIF\b", "") if kind == "IF" else t
        delta = delta + head_of(at, kind).cast("int") - ends_of(t, kind)
    return delta.cast("long")


def line_class(line: Column) -> Column:
    """if, elsif, else, end_if, label, code or blank. `IF(` without a space counts as code here, though it opens a structure for ctrl_delta."""
    t = norm_line(line)
    label = ~t.contains(":=") & t.rlike(r":(?!=)")
    return F.when(t == "", "blank").when(t.startswith("IF "), "if").when(t.startswith("ELSIF "), "elsif").when((t == "ELSE") | t.startswith("ELSE "), "else").when(t.startswith("END_IF"), "end_if").when(label, "label").otherwise("code")


def normal_var(name: Column) -> Column:
    """The trimmed name; null for truth values and for whatever reads as a number: signs, underscores between digits, exponents, nan and infinity."""
    t = stripped(name)
    number = r"(?i)^[+-]?((\d(_?\d)*\.?(\d(_?\d)*)?|\.\d(_?\d)*)(e[+-]?\d(_?\d)*)?|nan|inf|infinity)$"
    return F.when(F.upper(t).isin("TRUE", "FALSE") | t.rlike(number), None).otherwise(t)


def is_fb_type(name: Column) -> Column:
    """All in upper case, with the ending of function blocks."""
    return (name == F.upper(name)) & name.endswith("_FB")


def severity(level: Column) -> Column:
    """Of an XML fault's level: anything but a warning or a fatal one is an error."""
    return F.when(level.isin("WARNING", "FATAL"), level).otherwise("ERROR")


def schema_version(file_name: Column) -> Column:
    """Edition in a schema's file name, such as Ed1.0 of X_Ed1_0.xsd, or null."""
    stem = F.regexp_replace(F.substring_index(file_name, "/", -1), r"\.[^.]+$", "")
    part = F.try_element_at(F.split(stem, "_Ed"), F.lit(2))
    return F.concat(F.lit("Ed"), F.translate(part, "_", "."))


def schema_class(value: Column) -> Column:
    """num, str, bool, dict or list of a variant; null for null."""
    s = F.schema_of_variant(value)
    return F.when(s.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), "num").when(s == "STRING", "str").when(s == "BOOLEAN", "bool").when(s.rlike("^OBJECT"), "dict").when(s.rlike("^ARRAY"), "list")


#: Words of statements and expressions that name nothing. Fixed values.
WORDS = "IF THEN ELSIF ELSE END_IF CASE OF END_CASE FOR TO BY DO END_FOR WHILE END_WHILE REPEAT UNTIL END_REPEAT EXIT CONTINUE RETURN AND OR XOR NOT MOD TRUE FALSE".split()


def names_used(text: Column) -> Column:
    """(variables, functions) of statements, each sorted and once. Of a field access the base counts, of an array access base and index, of a call's arguments their values; the instance of a call that is a statement counts as neither."""
    name = r"[A-Za-z_]\w*"
    t = F.regexp_replace(strip_comments(text), r"'[^']*'|\"[^\"]*\"", " ")
    t = F.regexp_replace(t, rf"\b{name}#[\w.+:-]+|\.\s*{name}", " ")  # typed literals, fields
    t = F.regexp_replace(t, rf"([(,])\s*{name}\s*(?::=|=>)", "$1 ")  # names of arguments
    t = F.regexp_replace(t, rf"(?i)(^|;|\b(?:THEN|ELSE|DO|REPEAT|OF)\b|:(?!=))(\s*)(?!(?:{'|'.join(WORDS)})\b){name}(\s*\()", "$1$2$3")
    own = lambda found: F.array_sort(F.filter(F.array_distinct(found), lambda x: ~F.upper(x).isin(WORDS)))
    return F.struct(own(F.regexp_extract_all(t, F.lit(rf"\b({name})\b(?!\s*\()"))).alias("variables"), own(F.regexp_extract_all(t, F.lit(rf"\b({name})\s*\("))).alias("functions"))
