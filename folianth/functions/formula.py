"""LaTeX formulas as inline HTML: symbols, fractions, raised and lowered groups."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

# Commands that stand for one sign; Greek letters come from the names of the Unicode data.
SIGNS = {
    "times": "×", "cdot": "·", "div": "÷", "pm": "±", "mp": "∓", "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "approx": "≈", "equiv": "≡", "sim": "∼", "propto": "∝", "infty": "∞",
    "partial": "∂", "nabla": "∇", "sum": "∑", "prod": "∏", "int": "∫", "sqrt": "√", "rightarrow": "→", "to": "→", "leftarrow": "←", "Rightarrow": "⇒", "leftrightarrow": "↔", "in": "∈", "notin": "∉", "subset": "⊂",
    "subseteq": "⊆", "cup": "∪", "cap": "∩", "circ": "°", "bar": "¯", "overline": "¯", "hat": "^", "quad": " ", "qquad": " ", "ldots": "…", "cdots": "⋯", "forall": "∀", "exists": "∃", "ast": "*", "star": "*", "bullet": "•",
    "dots": "…", "Leftarrow": "⇐", "Leftrightarrow": "⇔", "langle": "⟨", "rangle": "⟩", "varepsilon": "ε", "varphi": "φ", "vartheta": "ϑ", "left": "", "right": "",
}
FONTS = re.compile(r"\\?(?:mathrm|mathbf|mathit|mathsf|mathcal|operatorname|text)\s*\{([^{}]*)\}")
FRACTION = re.compile(r"\\frac\s*\{([^{}]+)\}\s*\{([^{}]+)\}")
COMMAND = re.compile(r"\\([A-Za-z]+)")


@lru_cache(maxsize=1)
def signs() -> dict[str, str]:
    out = dict(SIGNS)
    for code in range(0x391, 0x3CA):
        name = unicodedata.name(chr(code), "").split()
        if len(name) == 4 and name[:1] == ["GREEK"] and name[2] == "LETTER":
            word = {"LAMDA": "lambda"}.get(name[3], name[3].lower())
            out.setdefault(word.capitalize() if name[1] == "CAPITAL" else word, chr(code))
    return out


def _raised(text: str) -> str:
    for mark, tag in (("^", "sup"), ("_", "sub")):
        group, one = re.compile(re.escape(mark) + r"\{([^{}]*)\}"), re.compile(re.escape(mark) + r"([A-Za-z0-9+\-=∞α-ωΑ-Ω①-⑨])")
        while group.search(text):
            text = group.sub(lambda m, tag=tag: f"<{tag}>{m.group(1)}</{tag}>", text)
        text = one.sub(rf"<{tag}>\1</{tag}>", text)
    return text


def inline(latex: str | None) -> str | None:
    """The formula as HTML; null stays null, unknown commands lose their backslash."""
    if latex is None:
        return None
    text = latex.strip()
    while FONTS.search(text):
        text = FONTS.sub(r"\1", text)
    text = COMMAND.sub(lambda m: m.group(0) if m.group(1) == "frac" else signs().get(m.group(1), m.group(0)), text)
    text = re.sub(r"\\([;,{} ])", lambda m: " " if m.group(1) in ";, " else m.group(1), text).replace("^°", "°")
    text = _raised(html.escape(text))
    while (m := FRACTION.search(text)) is not None:
        text = text[: m.start()] + f'<span class="frac"><sup>{m.group(1)}</sup>/<sub>{m.group(2)}</sub></span>' + text[m.end() :]
    return f'<span class="math-inline">{text.replace(chr(92), "")}</span>'


def in_html(text: str) -> str:
    """HTML in which formulas between dollar signs on one line are written out."""
    return re.sub(r"\$([^$\n]+)\$", lambda m: inline(html.unescape(m.group(1))) or "", text)
