"""Text functions on columns: titles, comments, templates, symbols, answers."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common words by language, and letters that English doesn't use.
ENGLISH = "the a an is are to of and or that be must should within in for at if then when not never always from with by before after until each every any can will this it on away again do don".split()
OTHER_WORDS = {
    "de": "der die das und ist nicht mit ein eine wird werden zu auf".split(),
    "fr": "le la les et est une des du dans pour que doit pas".split(),
    "es": "el los las y es una del para que debe con".split(),
    "it": "il lo gli che di una per non deve della nel".split(),
    "pt": "os que uma não para com deve das dos".split(),
    "tr": "ve bir bu için ile olan olarak gibi kadar".split(),
}
OTHER_SCRIPT = "[\\x{0400}-\\x{04FF}\\x{0600}-\\x{06FF}\\x{3040}-\\x{30FF}\\x{4E00}-\\x{9FFF}\\x{AC00}-\\x{D7AF}]"
TURKISH = "[ğışĞİŞ]"
RELEVANCE_TERMS = ["stl", "mtl", "mitl", "temporal logic", "signal", "falsification", "cyber-physical", "specification", "monitoring", "robustness", "verification", "control barrier", "autonomous", "shield"]
KEYWORDS = (
    "always eventually never until unless within whenever every least most once globally finally release releases released next future now currently current consecutive consecutively "
    "continuously permanently forever persistently sometime sometimes later previous subsequently afterwards thereafter starting beginning since till throughout immediately instant moment "
    "point interval period window deadline time times step steps second seconds minute minutes hour hours ms unit units s sec min h if then iff implies imply implied either neither nor both "
    "true false holds hold held satisfied satisfies satisfy violated must should shall cannot except whether otherwise also greater less larger smaller higher lower exceed exceeds exceeding "
    "equal equals maximum minimum max min positive negative zero upper bound bounded bounds inside outside beyond reach reaches reached remain remains stay stays keep keeps avoid avoids far "
    "close near absolute value one two three four five six seven eight nine ten twice half percent"
).split()
TEMPORAL_NAMES = ["G", "F", "U", "R", "X", "inf"]
SYNONYMS = [  # in this order; each replacement is followed by a space
    (r"\\square(?![a-zA-Z])", r"\\Box"), (r"\\(?:lozenge|diamond|diamondsuit)(?![a-zA-Z])", r"\\Diamond"), (r"\\land(?![a-zA-Z])", r"\\wedge"), (r"\\lor(?![a-zA-Z])", r"\\vee"),
    (r"\\lnot(?![a-zA-Z])", r"\\neg"), (r"\\(?:to|rightarrow|implies|Rightarrow|Longrightarrow)(?![a-zA-Z])", r"\\rightarrow"),
    (r"\\(?:iff|Leftrightarrow|Longleftrightarrow|leftrightarrow)(?![a-zA-Z])", r"\\Leftrightarrow"), (r"\\(?:leq|leqslant)(?![a-zA-Z])", r"\\le"), (r"\\(?:geq|geqslant)(?![a-zA-Z])", r"\\ge"),
    (r"\\varphi(?![a-zA-Z])", r"\\phi"), (r"\\varepsilon(?![a-zA-Z])", r"\\epsilon"), (r"\\vartheta(?![a-zA-Z])", r"\\theta"), (r"\\widetilde(?![a-zA-Z])", r"\\tilde"), (r"\\widehat(?![a-zA-Z])", r"\\hat"),
    (r"\\mid(?![a-zA-Z])", "|"), (r"\\(max|min)(?![a-zA-Z])", "$1"), (r"\\(?:mathcal|mathbf|mathsf|mathrm)\{U\}|\\until(?![a-zA-Z])", "U"), (r"\\(?:left|right|big|Big|bigg|Bigg)(?![a-zA-Z])", ""),
    (r"\\coloneqq|:=|\\triangleq|\\equiv|\\doteq", "="),
]
SPACING = r"\\[,;:! ]|~|\\q?quad(?![a-zA-Z])"
LAYOUT = r"\\n(?![a-zA-Z])|" + SPACING + r"|\\\\(?:\s*\[[^\]]*\])?|&|\$|\\label\{[^{}]*\}|\\(?:nonumber|notag)(?![a-zA-Z])|\\(?:begin|end)\{[a-zA-Z*]+\}(?:\[[^\]]*\])?(?:\{[^{}]*\})?|\\[\[\]]|\s+"
FONTS = r"\\(?:math(?:bf|rm|it|sf|tt|cal|bb|frak|scr)|text(?:bf|rm|it|sf|tt|normal)?|rm|bf|it|sf|tt|cal|boldsymbol|bm|operatorname\*?)(?![a-zA-Z])|[{}]|\\(?![a-zA-Z])"
OPERATOR = r"\\(?:square|Box|Diamond|lozenge|diamondsuit|boxminus|diamondminus|always|eventually|until|glob|even|alw|ev|fut|since|Since|once|historically|release|LTLg|LTLf|LTLu|G|F|U)(?![A-Za-z])|\\math(?:bf|sf|cal|rm)\{[GFU]\}|(?<![A-Za-z\\])[GFU](?![A-Za-z])"
BOUNDS = r"[_^]\s*\{[^{}]*\}|[_^]\s*\\?\w+"
BRACKETS = r"\\(?:left|right|big|Big|bigg|Bigg)(?![A-Za-z])|[{}()\[\]$.,;:\s]"
EDGE = r"(?:\\(?:wedge|land|vee|lor|rightarrow|Rightarrow|implies|to|bigwedge|bigvee)(?![A-Za-z])|=)\s*$|^\s*(?:\\(?:wedge|land|vee|lor)(?![A-Za-z])|=)"
DISABLED = r"(?s)\\begin\{comment\}.*?\\end\{comment\}|\\iffalse(?![a-zA-Z]).*?\\fi(?![a-zA-Z])"
WORD = r"[\w'\-*@]+"
NAME = r"[A-Za-z_][A-Za-z0-9_]*"
SYMBOL = r"\d+(?:\.\d+)?|[A-Za-z_][A-Za-z0-9_']*"
#: What lays a formula out inside the stretch that is kept.
INNER = r"\\label\{[^{}]*\}|\\(?:nonumber|notag|displaystyle|textstyle|scriptstyle|allowbreak)(?![a-zA-Z])|\\[hv]space\*?\{[^{}]*\}|\\q?quad(?![a-zA-Z])|\\\\(?:\s*\[[^\]]*\])?|&"
#: Commands and the characters they print; characters written in several ways; marks and layout of passages.
PRINTED = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ε", "varepsilon": "ε", "zeta": "ζ", "eta": "η", "theta": "θ", "vartheta": "θ", "iota": "ι", "kappa": "κ", "lambda": "λ", "mu": "μ", "nu": "ν", "xi": "ξ",
    "pi": "π", "rho": "ρ", "sigma": "σ", "tau": "τ", "upsilon": "υ", "phi": "φ", "varphi": "φ", "chi": "χ", "psi": "ψ", "omega": "ω",
    "Gamma": "Γ", "Delta": "Δ", "Theta": "Θ", "Lambda": "Λ", "Xi": "Ξ", "Pi": "Π", "Sigma": "Σ", "Phi": "Φ", "Psi": "Ψ", "Omega": "Ω",
    "in": "∈", "notin": "∉", "forall": "∀", "exists": "∃", "le": "≤", "leq": "≤", "ge": "≥", "geq": "≥", "neq": "≠", "ne": "≠", "to": "→", "rightarrow": "→", "Rightarrow": "⇒", "leftarrow": "←", "wedge": "∧", "land": "∧",
    "vee": "∨", "lor": "∨", "neg": "¬", "lnot": "¬", "infty": "∞", "cdot": "·", "times": "×", "oplus": "⊕", "sqcap": "⊓", "sqcup": "⊔", "subseteq": "⊆", "sqsubseteq": "⊑", "cap": "∩", "cup": "∪", "Box": "□", "square": "□",
}
SAME = {"−": "-", "–": "-", "—": "-", "’": "'", "‘": "'", "′": "'"}
PASSAGE_MARKS = r"\\(?:math(?:bf|rm|it|sf|tt|cal|bb)|text(?:bf|rm|it|sf|tt)?|emph|bm|boldsymbol|operatorname)(?![a-zA-Z])|[{}_^]"
PASSAGE_LAYOUT = r"\\n(?![a-zA-Z])|\\[,;:! ]|~|\\q?quad(?![a-zA-Z])|-?\\\\|-\s+(?=[a-z])|\$|``|''|[\"“”]|⟦/?[A-Z]\d+⟧|\\(?![a-zA-Z])|\s+"
# End of fixed values.


def normalize_title(title: Column) -> Column:
    """Lower case, only letters, digits and underscores (of any script)."""
    return F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"(?U)\W+", "")


def strip_comments(text: Column) -> Column:
    """``%`` to the end of its line goes, unless escaped."""
    return F.regexp_replace(text, r"(?m)(?<!\\)%.*$", "")


def strip_disabled(text: Column) -> Column:
    """Comments go, then comment environments and ``\\iffalse`` ... ``\\fi``."""
    return F.regexp_replace(strip_comments(text), DISABLED, "")


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _among(words: Column, vocabulary: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(vocabulary)))


def is_english(text: Column) -> Column:
    """False if over 30 % of the letters are of other scripts, if three are Turkish, or if another language has two common
    words and more than English; null counts as empty text, which is English."""
    text = F.coalesce(text, F.lit(""))
    size = lambda pattern: F.char_length(F.regexp_replace(text, pattern, ""))
    # a search for bytes first: a text of ASCII letters only, or without a Turkish one, is not counted further
    scripts = (F.octet_length(text) > F.char_length(text)) & text.rlike(OTHER_SCRIPT) & ((F.char_length(text) - size(OTHER_SCRIPT)) / F.greatest(F.lit(1), F.char_length(text) - size(r"\p{L}+")) > 0.3)
    turkish = functools.reduce(lambda a, b: a | b, (F.contains(text, F.lit(x)) for x in TURKISH.strip("[]"))) & text.rlike(f"(?s){TURKISH}.*{TURKISH}.*{TURKISH}")
    marked = F.contains(text, F.lit("\\")) | F.contains(text, F.lit("$"))
    plain = F.when(marked, F.regexp_replace(text, r"\\[A-Za-z]+|\$[^$]*\$", " ")).otherwise(text)
    words = F.split(F.lower(plain), r"[^\p{L}]+")
    known = sorted({w for v in [ENGLISH, *OTHER_WORDS.values()] for w in v})

    def mostly_other(common: Column) -> Column:
        other = F.greatest(*(_among(common, v) for v in OTHER_WORDS.values()))
        return (other >= 2) & (other > _among(common, ENGLISH))

    return ~(scripts | turkish | once(F.filter(words, lambda w: w.isin(known)), mostly_other))


def is_relevant(title: Column, abstract_words: Column | None = None) -> Column:
    """A relevance term is a substring of the lower-case title, or of the abstract's words joined by spaces."""
    found = F.lower(F.coalesce(title, F.lit(""))).rlike("|".join(RELEVANCE_TERMS))
    if abstract_words is not None:
        found = found | F.lower(F.coalesce(F.concat_ws(" ", abstract_words), F.lit(""))).rlike("|".join(RELEVANCE_TERMS))
    return found


def formula_key(text: Column) -> Column:
    """Two transcriptions of one formula have the same key: synonyms, layout, fonts and final punctuation aside."""
    for pattern, replacement in SYNONYMS:
        text = F.regexp_replace(text, pattern, replacement + " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, LAYOUT, ""), FONTS, ""), r"[.,;]+$", "")


def is_fragment(formula: Column) -> Column:
    """An operator alone, without what it applies to."""
    rest = F.regexp_replace(F.regexp_replace(formula, BOUNDS, " "), OPERATOR, " ")
    return F.regexp_replace(rest, BRACKETS, "") == ""


def looks_cut(formula: Column) -> Column:
    """Starts or ends with a connective, so that its other part is elsewhere."""
    return formula.rlike(EDGE)


def template_of(text: Column) -> Column:
    """Numbers and parameters in bounds as ``#``, names as a, b, ... in order of appearance (v27, v28, ... after z).

    ``inf`` stays, and so do the operators G F U R before an interval. Interval bounds are rewritten on their own.
    """
    bounds = F.regexp_replace(text, r"\s+", " ")
    tokens = F.regexp_extract_all(bounds, F.lit(r"([GFUR][\[(][^\[\]()]*[\])]|[A-Za-z_][A-Za-z0-9_]*|\d+(?:\.\d+)?|<->|->|&&|\|\||[<>=!]=|\s+|.)"), 1)
    names = F.array_distinct(F.filter(tokens, lambda t: t.rlike(rf"^{NAME}$") & ~t.isin("inf", "true", "false")))

    def bound(side: Column) -> Column:
        return F.when(F.trim(side) == "inf", F.lit("inf")).otherwise(F.lit("#"))

    def written(t: Column) -> Column:
        at = F.array_position(names, t).cast("int")
        letter = F.when(at <= 26, F.chr(at + 96)).otherwise(F.concat(F.lit("v"), at.cast("string")))
        inner = F.split(F.substring(t, 3, 1 << 20), ",")
        interval = F.concat(F.substring(t, 1, 2), bound(F.get(inner, F.lit(0))), F.lit(","), bound(F.regexp_replace(F.get(inner, F.lit(1)), r"[\])]$", "")), F.substring(t, -1, 1))
        return (
            F.when(t.rlike(r"^[GFUR][\[(][^,]*,[^,]*[\])]$"), interval).when(t.rlike(r"^\d"), F.lit("#")).when(t.isin("inf", "true", "false"), t).when(t.rlike(rf"^{NAME}$"), letter).otherwise(t)
        )

    return F.array_join(F.transform(tokens, written), "")


def pattern_tokens(pattern: Column) -> Column:
    """Distinct operators of a pattern text, in order of appearance; ``<->`` is not ``->``."""
    found = F.regexp_extract_all(pattern, F.lit(r"(<->|->|&&|\|\||!|[GFUR](?=[\[(]))"), 1)
    return F.array_distinct(found)


def frozen_words(description: Column, formula: Column) -> Column:
    """Lower-case words no rewriting may change: keywords, the formula's names, single letters, words with a digit or ``_``."""
    words = F.transform(F.regexp_extract_all(description, F.lit(f"({WORD})"), 1), F.lower)
    names = F.transform(F.regexp_extract_all(formula, F.lit(f"({NAME})"), 1), F.lower)
    keep = F.filter(words, lambda w: w.isin(KEYWORDS) | F.array_contains(names, w) | (F.length(w) == 1) | w.rlike(r"[_\d]"))
    return F.array_sort(F.array_distinct(keep))


def lost_words(original: Column, rewritten: Column, frozen: Column) -> Column:
    """Frozen words that the rewritten text has fewer times than the original."""
    split = lambda c: F.transform(F.regexp_extract_all(c, F.lit(f"({WORD})"), 1), F.lower)
    before, after = split(original), split(rewritten)
    times = lambda words, w: F.size(F.filter(words, lambda x: x == w))
    return F.filter(frozen, lambda w: times(after, w) < times(before, w))


def missing_symbols(original: Column, rewritten: Column, formula: Column) -> Column:
    """Numbers and symbols of the original that the rewritten text lacks: lower case, distinct, in order."""
    tokens = lambda c: F.transform(F.regexp_extract_all(c, F.lit(f"({SYMBOL})"), 1), F.lower)
    names = F.transform(F.filter(F.regexp_extract_all(formula, F.lit(f"({NAME})"), 1), lambda n: ~n.isin(TEMPORAL_NAMES)), F.lower)
    marked = F.filter(tokens(original), lambda t: t.rlike(r"[_\d]") | F.array_contains(names, t))
    return F.array_except(F.array_distinct(marked), tokens(rewritten))


def content_key(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of what was read."""
    return F.left(F.sha2(F.to_json(F.struct(*(p.alias(f"p{i}") for i, p in enumerate(parts)))), 256), F.lit(16))


def content_key_text(text: Column) -> Column:
    return F.left(F.sha2(text, 256), F.lit(16))


def split_model_label(label: Column) -> tuple[Column, Column]:
    """``provider/model:level`` as (model, level); level is ``off`` if not given."""
    level = F.regexp_extract(label, r":([^:/]*)$", 1)
    return F.regexp_replace(label, r":[^:/]*$", ""), F.when(level == "", F.lit("off")).otherwise(level)


def clean_text(text: Column) -> Column:
    """Without control characters except tab and line breaks."""
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def without_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def contains_ignoring_spaces(text: Column, part: Column) -> Column:
    return F.contains(without_spaces(text), without_spaces(part))


def find_ignoring_spaces(text: Column, part: Column) -> Column:
    """Struct (start, stop) of the first place of ``part`` in ``text``, white space aside, as positions in ``text``; else null.

    The text is searched by a pattern of the part's characters with any white space between them.
    """
    escaped = F.regexp_replace(without_spaces(part), r"(?s)([^A-Za-z0-9])", r"\\$1")
    spaced = F.regexp_replace(escaped, r"(?s)(\\?.)", r"$1\\s*")
    pattern = F.substring(spaced, F.lit(1), F.char_length(spaced) - 3)  # without white space after the last one
    found = once(pattern, lambda p: F.struct(F.regexp_instr(text, p).alias("at"), F.char_length(F.regexp_substr(text, p)).alias("n")))
    place = F.struct((found["at"] - 1).cast("long").alias("start"), (found["at"] - 1 + found["n"]).cast("long").alias("stop"))
    return F.when((F.char_length(without_spaces(part)) > 0) & (found["at"] > 0), place)


def layout_map(text: Column) -> Column:
    """Struct (tokens, places): the text as layout and single characters, and which tokens are characters that count.

    ``places`` leads from a position in the text without layout to the token it came from.
    """
    tokens = F.regexp_extract_all(text, F.lit(f"(?s)({LAYOUT}|.)"), 1)
    kept = lambda t: (F.char_length(t) == 1) & ~t.rlike(r"^[~&$\s]$")
    return once(tokens, lambda t: F.struct(t.alias("tokens"), F.filter(F.transform(t, lambda x, i: F.when(kept(x), i)), lambda i: i.isNotNull()).alias("places")))


def cleaned_formula(formula: Column) -> Column:
    """Without labels, row breaks, alignment and style commands, with single spaces, without final punctuation."""
    return F.rtrim(F.trim(F.regexp_replace(F.regexp_replace(formula, INNER, " "), r"\s+", " ")), F.lit(".,;"))


def trim_formula(source: Column, copies: Column) -> Column:
    """Struct (formula, found): the stretch of the source that the first copy found in it stands for, layout aside, cleaned, and
    true; else all of the source, cleaned. A null source has no formula."""

    def stretch(m: Column) -> Column:
        core = F.array_join(F.transform(m["places"], lambda i: F.get(m["tokens"], i)), "")
        bare = F.transform(copies, lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), LAYOUT, ""))
        places = F.transform(bare, lambda c: F.struct(F.when(c != "", F.position(c, core)).otherwise(0).alias("at"), F.char_length(c).alias("n")))
        hit = F.get(F.filter(places, lambda h: h["at"] > 0), F.lit(0))
        first, last = F.get(m["places"], hit["at"] - 1), F.get(m["places"], hit["at"] + hit["n"] - 2)
        return F.when(hit.isNotNull(), F.array_join(F.slice(m["tokens"], first + 1, last - first + 1), ""))

    found = once(layout_map(source), stretch)
    whole = F.regexp_replace(F.trim(source), r"^\$+|\$+$", "")
    return F.struct(cleaned_formula(F.coalesce(found, whole)).alias("formula"), found.isNotNull().alias("found"))


def passage_core(text: Column) -> Column:
    """A passage as it is compared with its copy: NFKC, printed characters for symbols, without fonts, marks and layout."""
    one = F.translate(F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True)), "".join(SAME), "".join(SAME.values()))
    printed = F.create_map(*(F.lit(x) for pair in PRINTED.items() for x in pair))
    parts = F.regexp_extract_all(one, F.lit(r"(?s)(\\[A-Za-z]+|[^\\]+|\\)"), 1)
    signs = F.transform(parts, lambda p: F.when(F.startswith(p, F.lit("\\")), F.coalesce(F.try_element_at(printed, F.substring(p, 2, 1 << 20)), p)).otherwise(p))
    return F.when(text.isNotNull(), F.regexp_replace(F.regexp_replace(F.array_join(signs, ""), PASSAGE_MARKS, ""), PASSAGE_LAYOUT, ""))


def first_abstract(text: Column, most: int = 2500) -> Column:
    """The abstract environment's text with single spaces, cut at a word before ``most`` characters."""
    found = F.trim(F.regexp_replace(F.regexp_extract(text, r"(?s)\\begin\{abstract\}(.*?)\\end\{abstract\}", 1), r"\s+", " "))
    return F.when(F.length(found) > most, F.regexp_replace(F.substring(found, 1, most), r"\s+\S*$", "")).otherwise(found)


def classify_bounds(low: Column, high: Column, closing: Column) -> Column:
    """concrete: both bounds are numbers (or infinity); null: none is and the brackets are round; symbolic otherwise."""
    number = r"^\s*(\d+(\.\d+)?|\.\d+|[+-]?\s*\\infty|[+-]?\s*(∞|inf))\s*$"
    both, any_ = low.rlike(number) & high.rlike(number), low.rlike(number) | high.rlike(number)
    return F.when(both, "concrete").when(~any_ & (closing == ")"), F.lit(None)).otherwise("symbolic")


def missing_bounds(transcription: Column, operators: Column) -> Column:
    """Numbers of a line's operators that a transcription lacks, if it holds those of none of them.

    ``operators``: array of arrays of numbers as text.
    """
    numbers = F.regexp_extract_all(F.coalesce(transcription, F.lit("")), F.lit(r"(\d+(?:\.\d+)?)"), 1)
    whole = F.exists(operators, lambda o: F.forall(o, lambda n: F.array_contains(numbers, n)))
    return F.when(whole, F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(F.flatten(operators), lambda n: ~F.array_contains(numbers, n))))


def answer_body(text: Column) -> Column:
    """JSON of an answer without a code fence around it."""
    return F.regexp_replace(F.trim(text), r"(?s)^```(?:json)?\s*(.*?)\s*```$", "$1")


_JUDGED = "struct<judgments:array<struct<id:string,describes:string,faithful:string>>>"


def validate_judgment(answer: Column, n: Column) -> Column:
    """null if the answer judges exactly D1..Dn consistently, else what is wrong with it."""
    got = F.from_json(answer_body(answer), _JUDGED)
    keys = F.json_object_keys(answer_body(answer))
    ids = F.transform(got["judgments"], lambda j: j["id"])
    expected = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("D"), i.cast("string")))
    no = F.exists(got["judgments"], lambda j: (j["describes"] == "no") & j["faithful"].isNotNull())
    yes = F.exists(got["judgments"], lambda j: (j["describes"] == "yes") & ~F.coalesce(j["faithful"].isin("correct", "ambiguous", "wrong"), F.lit(False)))
    unknown = F.exists(got["judgments"], lambda j: ~F.coalesce(j["describes"].isin("yes", "no"), F.lit(False)))
    return (
        F.when(keys.isNull() | got["judgments"].isNull(), "not the expected JSON").when(keys != F.array(F.lit("judgments")), "another key").when(F.array_sort(ids) != F.array_sort(expected), "ids differ")
        .when(unknown, "unknown answer").when(no, "no with a label").when(yes, "yes without a label")
    )


def judged_label(describes: Column, faithful: Column) -> Column:
    """The one label of a judgment."""
    return F.when(describes == "no", F.lit("no")).otherwise(faithful)


def validate_paraphrases(answer: Column, k: int) -> Column:
    """The texts, spaces collapsed, if the answer is JSON with exactly ``k`` non-empty strings; else null."""
    got = F.from_json(answer_body(answer), "struct<paraphrases:array<string>>")["paraphrases"]
    texts = F.transform(got, lambda t: F.trim(F.regexp_replace(t, r"\s+", " ")))
    return F.when((F.size(texts) == k) & F.forall(texts, lambda t: F.coalesce(t != "", F.lit(False))), texts)


# Kinds of passages and domains that an answer may name.
KINDS = ["specific", "generic"]
DOMAINS = [
    "aerial robotics", "automotive", "aviation", "epidemiology", "industrial machinery", "marine robotics", "mechatronics", "mobile robotics", "power systems", "railway", "robotic manipulation", "smart city", "smart home", "social dynamics", "generic",
]
# End of fixed values.


def _symbols(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, LAYOUT, ""), FONTS, "")


def in_formula(symbol: Column, formula: Column) -> Column:
    """Whether a symbol is written in a formula, or another one of its indexed family (``x_3`` where the formula has ``x_i``)."""
    core, whole = _symbols(symbol), _symbols(formula)
    family = F.regexp_extract(core, r"^([^_^]*)[_^]", 1)
    written = F.regexp_replace(family, r"([^A-Za-z0-9])", r"\\$1")
    return F.contains(whole, core) | ((family != "") & F.regexp_like(whole, F.concat(F.lit(r"(?<![A-Za-z\\])"), written, F.lit("(?![A-Za-z])"))))


def check_extraction(formula: Column, source: Column, passages: Column, domain: Column, symbols: Column, transcribed: Column, operators: Column) -> Column:
    """What is wrong with one answer, in the order of its parts.

    ``passages``: array of structs (kind, state), where the state is what ``check_passage`` says; ``operators``: arrays of the
    bounds of a line's operators, which a formula ``transcribed`` from a picture is held against instead of its source.
    """
    core = lambda c: F.regexp_replace(c, LAYOUT, "")
    none = F.coalesce(F.trim(formula), F.lit("")) == ""
    lacking = missing_bounds(formula, operators)
    several = F.size(passages) > 1
    which = lambda i: F.when(several, F.concat(F.lit(" (passage "), (i + 1).cast("string"), F.lit(")"))).otherwise("")
    first = F.array_compact(F.array(
        F.when(none, "no formula").when(transcribed & (F.size(lacking) > 0), F.concat(F.lit("bounds missing: "), F.array_join(lacking, ", "))).when(~transcribed & ~F.contains(core(source), core(formula)), "not a copy"),
    ))
    state = lambda p: F.when(p["state"] == "joined", "passage joined").when(p["state"] == "not a copy", "passage not a copy")
    kind = lambda p: F.when(~F.coalesce(p["kind"].isin(KINDS), F.lit(False)), F.concat(F.lit("unknown kind: "), F.coalesce(F.when(p["kind"] != "", p["kind"]), F.lit("(none)"))))
    each = F.flatten(F.transform(passages, lambda p, i: F.transform(F.array_compact(F.array(state(p), kind(p))), lambda x: F.concat(x, which(i)))))
    mixed = F.when(F.size(F.array_distinct(F.transform(passages, lambda p: p["kind"]))) > 1, "mixed kinds")
    unknown = F.when(~F.coalesce(domain.isin(DOMAINS), F.lit(False)), F.concat(F.lit("unknown domain: "), F.coalesce(F.when(domain != "", domain), F.lit("(none)"))))
    strange = F.transform(F.filter(symbols, lambda x: ~in_formula(x, F.coalesce(formula, F.lit("")))), lambda x: F.concat(F.lit("symbol not in formula: "), x))
    return F.concat(first, each, F.array_compact(F.array(mixed, unknown)), strange)


def given_passages(passages: Column) -> Column:
    """Passages (structs with text) of an answer that count: no blank ones, none that only says null or none, each text once, spaces aside."""
    real = F.filter(passages, lambda p: ~F.coalesce(F.lower(F.trim(p["text"])), F.lit("")).isin("", "null", "none"))
    texts = F.transform(real, lambda p: without_spaces(p["text"]))
    return F.filter(real, lambda p, i: F.array_position(texts, without_spaces(p["text"])) == i + 1)


def verdict_by_agreement(first: Column, second: Column) -> Column:
    """Whom a third answer supports, by how far it agrees with the first and with the second one."""
    agreed = lambda c: c.isin("same passages", "both none")
    partly = (first == "partly the same") | (second == "partly the same")
    return F.when(agreed(first) & agreed(second), "agrees with both").when(agreed(first), "sides with the first").when(agreed(second), "sides with the second").when(partly, "partly agrees").otherwise("agrees with neither")


# Where an arXiv id stands in a link.
ARXIV_LINK = r"arxiv\.org/(?:abs|pdf)/([0-9]{4}\.[0-9]{4,5}|[a-z\-]+/[0-9]{7})"
# End of fixed values.
WORK = "struct<id:string,ids:struct<arxiv:string>,doi:string,display_name:string,publication_year:int,cited_by_count:long,open_access:struct<is_oa:boolean,oa_url:string>,locations:array<struct<license:string,landing_page_url:string,pdf_url:string>>>"


def project_work(work: Column) -> Column:
    """A catalogue work (JSON) as a record: ids, the arXiv id from its own link or else from its locations', PDF links, licences."""
    w = F.from_json(work, WORK)
    places = F.coalesce(w["locations"], F.array().cast("array<struct<license:string,landing_page_url:string,pdf_url:string>>"))
    links = F.flatten(F.transform(places, lambda p: F.array(p["landing_page_url"], p["pdf_url"])))
    arxiv = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), ARXIV_LINK, 1), F.lit(""))
    found = F.get(F.filter(F.transform(links, arxiv), lambda x: x.isNotNull()), F.lit(0))
    pdfs = F.array_distinct(F.filter(F.concat(F.transform(places, lambda p: p["pdf_url"]), F.array(w["open_access"]["oa_url"])), lambda u: F.coalesce(u != "", F.lit(False))))
    licenses = F.array_sort(F.array_distinct(F.filter(F.transform(places, lambda p: F.lower(p["license"])), lambda x: F.coalesce(x != "", F.lit(False)))))
    return F.struct(
        F.element_at(F.split(w["id"], "/"), -1).alias("paper_id"), F.coalesce(arxiv(w["ids"]["arxiv"]), found).alias("arxiv_id"), w["doi"].alias("doi"), w["display_name"].alias("title"), w["publication_year"].alias("year"),
        F.coalesce(w["cited_by_count"], F.lit(0)).alias("cited_by"), F.coalesce(w["open_access"]["is_oa"], F.lit(False)).alias("is_oa"), pdfs.alias("pdf_mirrors"), licenses.alias("licenses"),
    )
