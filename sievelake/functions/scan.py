"""Scans of source files and pages for bounded temporal operators: small helpers per paper, run by grouped Spark jobs."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Commands that draw a temporal operator, names of operators, fonts, math environments.
SYMBOLS = "square lozenge Box Diamond diamond diamondsuit blacksquare blacklozenge boxminus boxplus diamondminus diamondplus".split()
WORDS = "always eventually globally finally until release once since historically".split()
FONTS = "mathcal mathbf mathsf mathrm mathit mathtt boldsymbol bm textbf textsf textrm text operatorname mathop mathbin mathrel ensuremath".split()
MATH = "equation align alignat flalign gather multline eqnarray displaymath math".split()
GLYPHS = "□◇◊♢⋄♦◻■◆⊟⊞"
# End of fixed values.

_DEFINITION = re.compile(r"\\(?:(?:re)?newcommand|providecommand|DeclareMathOperator)\*?\s*\{?\s*\\([A-Za-z]+)\s*\}?\s*(?:\[\d\])?\s*\{|\\def\s*\\([A-Za-z]+)\s*(?:#\d)*\s*\{")
_SYMBOL = re.compile(rf"\\(?:{'|'.join(SYMBOLS)})(?![A-Za-z])")
_WRAP = re.compile(rf"\\(?:{'|'.join(FONTS)})(?![A-Za-z])|\\[,!;: ]|[{{}}\s]")
_NAME = re.compile(rf"(?:[GFU]|(?i:{'|'.join(WORDS)}))$")
_INPUT = re.compile(r"\\(?:input|include)\s*\{([^{}]+)\}")
_NUMBER = r"(?:\d+(?:\.\d+)?|\.\d+|[+-]?\s*\\infty(?![A-Za-z]))"
_SPAN = re.compile(rf"(?s)\\begin\{{((?:{'|'.join(MATH)})\*?)\}}.*?\\end\{{\1\}}|(?<!\\)\\\[.*?\\\]|(?<!\\)\$\$.*?\$\$|(?<!\\)\$(?!\$).*?(?<!\\)\$")
_ROW = re.compile(r"\\\\(?:\s*\[[^\]]*\])?")
_EDGE = re.compile(r"\\(?:wedge|land|vee|lor|rightarrow|Rightarrow|implies|to)(?![A-Za-z])")
_PAGE = re.compile(rf"(?:[{GLYPHS}]|(?<![A-Za-z])[GFU]|\b(?:{'|'.join(WORDS)})\b)_?\{{?\s*[\[(]\s*([^,\[\]()]{{1,12}}),\s*([^,\[\]()]{{1,12}})([\])])", re.I)


def _body(text: str, at: int) -> str:
    depth, i = 1, at
    while i < len(text) and depth:
        depth += {"{": 1, "}": -1}.get(text[i], 0) if text[i - 1] != "\\" else 0
        i += 1
    return text[at : i - 1]


def temporal_macros(texts: list[str]) -> set[str]:
    """Macros whose body draws or names an operator, or uses such a macro."""
    bodies = {m[1] or m[2]: _body(t, m.end()) for t in texts for m in _DEFINITION.finditer(t)}
    found = {n for n, b in bodies.items() if _SYMBOL.search(b) or _NAME.match(_WRAP.sub("", b))}
    while True:
        more = {n for n, b in bodies.items() if n not in found and any(re.search(rf"\\{k}(?![A-Za-z])", b) for k in found)}
        if not more:
            return found
        found |= more


def document_files(files: dict[str, str]) -> set[str]:
    """Files reached by \\input from the main file that holds most text; all files if there is no main file."""
    stem = lambda p: re.sub(r"\.tex$", "", p.rsplit("/", 1)[-1])
    mains = [p for p, t in files.items() if r"\begin{document}" in t]
    if not mains:
        return set(files)
    by_stem = {stem(p): p for p in files}
    best: set[str] = set()
    for main in sorted(mains):
        seen, todo = set(), [main]
        while todo:
            p = todo.pop()
            if p not in seen:
                seen.add(p)
                todo += [by_stem[s] for m in _INPUT.finditer(files[p]) if (s := stem(m[1])) in by_stem]
        if sum(len(files[p]) for p in seen) > sum(len(files[p]) for p in best):
            best = seen
    return best


def operators(text: str, macros: set[str]) -> list[tuple[int, str]]:
    """(position, concrete or symbolic) of each operator with an interval."""
    own = "|".join(sorted(map(re.escape, {*SYMBOLS, *WORDS, *macros}), key=len, reverse=True))
    pattern = re.compile(rf"(?:\\(?:{own})(?![A-Za-z])|\\(?:{'|'.join(FONTS)})\s*\{{\s*[GFU]\s*\}}|(?<![A-Za-z\\])[GFU](?=\s*_))\s*[_^]?\s*\{{?\s*([\[(])\s*([^,\[\]()]+),\s*([^,\[\]()]+?)\s*([\])])")
    out = []
    for m in pattern.finditer(text):
        low, high = re.fullmatch(_NUMBER, m[2].strip()), re.fullmatch(_NUMBER, m[3].strip())
        if low and high:
            out.append((m.start(), "concrete"))
        elif low or high or m[4] == "]":
            out.append((m.start(), "symbolic"))
    return out


def units(text: str) -> list[tuple[int, int]]:
    """Math spans, cut at row breaks except where a row starts or ends with a connective."""
    out = []
    for m in _SPAN.finditer(text):
        at = m.start()
        for row in _ROW.finditer(text, m.start(), m.end()):
            before, after = text[at : row.start()].rstrip(" &"), text[row.end() : m.end()].lstrip(" &\n")
            last = list(_EDGE.finditer(before))
            if _EDGE.match(after) or (last and last[-1].end() == len(before)):
                continue
            out.append((at, row.start()))
            at = row.end()
        out.append((at, m.end()))
    return out


def scan_papers(files: DataFrame, paper: str = "paper_id", path: str = "path", text: str = "text") -> DataFrame:
    """(paper, path, position, kind, unit_start, unit_end, in_document) of every operator, with the paper's own macros.

    A paper's files meet in one task, so a paper must fit one; papers are independent of each other.
    """

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = {p: re.sub(r"(?<!\\)%.*", "", t or "") for p, t in zip(pdf["path"], pdf["text"], strict=True)}
        macros, inside, rows = temporal_macros(list(texts.values())), document_files(texts), []
        for p, t in sorted(texts.items()):
            spans = units(t)
            for at, kind in operators(t, macros):
                unit = next(((a, b) for a, b in spans if a <= at < b), (t.rfind("\n", 0, at) + 1, (t.find("\n", at) + 1 or len(t) + 1) - 1))
                rows.append((pdf["paper_id"].iloc[0], p, at, kind, *unit, p in inside))
        return pd.DataFrame(rows, columns=["paper_id", "path", "position", "kind", "unit_start", "unit_end", "in_document"])

    renamed = files.select(F.col(paper).alias("paper_id"), F.col(path).alias("path"), F.col(text).alias("text"))
    kind = renamed.schema["paper_id"].dataType.simpleString()
    return renamed.groupBy("paper_id").applyInPandas(scan, f"paper_id {kind}, path string, position long, kind string, unit_start long, unit_end long, in_document boolean")


def scan_pages(pages: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, line, kind) of every operator in page text, after NFKC; citations such as ``once [28, 36]`` are left out."""
    schema = pages.select(*keys).schema

    def scan(batches):
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                *own, body = row
                for number, line in enumerate(unicodedata.normalize("NFKC", body or "").split("\n")):
                    for m in _PAGE.finditer(line):
                        numeric = [bool(re.fullmatch(r"\d+(?:\.\d+)?|∞|inf", x.strip())) for x in m.group(1, 2)]
                        if re.match(r"[a-z]{4,}\s", m[0]) or (not any(numeric) and m[3] == ")"):
                            continue
                        rows.append((*own, number, "concrete" if all(numeric) else "symbolic"))
            yield pd.DataFrame(rows, columns=[*keys, "line", "kind"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return pages.select(*keys, text).mapInPandas(scan, f"{fields}, line long, kind string")
