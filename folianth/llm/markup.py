"""Problem 5: clean text from values that carry HTML, Markdown, wiki or LaTeX markup.

A value is parsed into a DOM (tags with implied ends; escaped tags are unescaped until nothing changes). For every node the
composite text density is computed: characters per tag, adjusted by the characters and tags of links. Text and inline
elements beside blocks make a paragraph of their own. The node with the largest sum of its children's densities is the subtree with
the content; the lowest density on its path to the body is the threshold for everything else: a subtree outside is kept at or above
it, and inside a part that carries links is kept only at or above it, so that a list of links goes wherever it stands.

Tables, lists, code and formulas are one unit: their own tags are structure and not counted, only the tags of their links are. A
part without any link is never dropped from the subtree, as short cells and headings have few characters but say something. A heading
or caption stands or falls with what follows it. Kept subtrees are written as text: rows as `a | b`, list items as `- x`, code
between backticks, formulas between `$`. Which kinds of markup a value holds is told from the parse: tags and entities seen by it,
and the signs of the other kinds in its text nodes. Markup that is no HTML is rewritten to the same forms.

Null gives null text and no kinds; the empty text gives the empty text; unclosed or crossed tags are closed where
their parent ends; whole values are processed, of any length.
"""

from __future__ import annotations

import html
import math
import re
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folianth.operators.nested import triples

# Element names of HTML that count as tags.
ELEMENTS = frozenset(
    "a abbr address article aside b big blockquote body br caption center cite code col colgroup dd del details div dl dt em figcaption figure font footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark math menu meta nav nobr ol option p pre q s samp script section select small span strike "
    "strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr tt u ul var video wbr mfrac mi mn mo mrow msub msup".split()
)
VOID = frozenset("br hr img input meta link col wbr".split())
BLOCKS = frozenset("p div section article main header footer blockquote pre table ul ol dl h1 h2 h3 h4 h5 h6 figure figcaption address body".split())
UNITS = frozenset("table ul ol dl pre code math blockquote".split())
HEADS = frozenset("h1 h2 h3 h4 h5 h6 caption figcaption".split())
DROPPED = frozenset("script style head template noscript".split())
#: An opening tag of the key ends open elements of the value, up to the enclosing one named after `|`.
ENDS = {
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}), "li": ({"li"}, {"ul", "ol", "menu"}), "p": ({"p"}, {"td", "div", "li"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "thead": ({"tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
ATTRIBUTES = r"""(?:\s+[A-Za-z_:@][\w:.-]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>`]+))?)*"""
TAG = re.compile(rf"<(/?)([A-Za-z][A-Za-z0-9]*)({ATTRIBUTES})\s*(/?)>|<!--.*?-->|<![A-Za-z][^>]*>|<\?[^>]*\?>", re.S)
ENTITY = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")

# LaTeX commands that make a text LaTeX even without braces (a path with backslashes has other words).
COMMANDS = (
    "alpha beta gamma delta epsilon varepsilon zeta eta theta vartheta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi varphi chi psi omega Gamma Delta Theta Lambda Xi Pi Sigma Upsilon Phi Psi Omega "
    "times cdot div pm mp leq le geq ge neq ne approx equiv sim propto infty partial nabla sum prod int oint lim log ln exp sin cos tan max min sup inf in notin subset supset cup cap forall exists to rightarrow leftarrow "
    "Rightarrow Leftrightarrow ldots cdots dots quad qquad left right big bigl bigr hline toprule midrule bottomrule cline limits displaystyle textstyle circ ast star bullet prime hbar ell degree"
).split()
LATEX = [
    re.compile(r"\\(?:begin|end)\s*\{"), re.compile(r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{"), re.compile(r"\\(?:" + "|".join(COMMANDS) + r")(?![A-Za-z\\])"), re.compile(r"\\\[.*?\\\]|\\\(.*?\\\)", re.S),
    re.compile(r"\$\$(?=\S).+?\$\$", re.S), re.compile(r"(?<![\\$\w])\$(?![\s$])(?=[^$\n]*[\\^_=A-Za-z])(?!\d+(?:[.,]\d+)*(?:\s|[-–~～/,;:)]|$))[^$\n]*[^\s$\\]\$(?![\d$])"),
    re.compile(r"(?<![\w\\])[A-Za-z](?:[_^]\{[^{}\n]*\})"), re.compile(r"[\w)\]}][\^_]\{[^{}\n]*\}"), re.compile(r"\S\s*\\\\\s*(?:$|\n|\\)"), re.compile(r"(?<=\d)\\%"),
]
#: A cell of the line below a table's head; a lone hyphen may be a cell without a value.
RULE = r"(?::-+:?|-+:|-{2,})"
MARKDOWN = [
    re.compile(rf"^[ \t]*\|?[ \t]*{RULE}[ \t]*(?:\|[ \t]*{RULE}[ \t]*)+\|?[ \t]*$", re.M), re.compile(rf"^[ \t]*\|[ \t]*{RULE}[ \t]*\|[ \t]*$", re.M), re.compile(r"^ {0,3}#{1,6}[ \t]+\S", re.M), re.compile(r"(?<![*\\])\*\*(?=[^\s*])[^*\n]*?(?<=[^\s*])\*\*(?!\*)"),
    re.compile(r"(?<![\w\\])__(?=[^\s_])[^_\n]*?(?<=[^\s_])__(?!\w)"), re.compile(r"(?<![\w*\\])\*(?=[^\s*])[^*\n{}\\]*?(?<=[^\s*])\*(?![\w*])"), re.compile(r"(?<![\w\\{}])_(?=[^\s_])[^_\n{}\\]*?(?<=[^\s_])_(?![\w{])"), re.compile(r"(?<!`)`[^`\n]+`(?!`)"), re.compile(r"^[ \t]*(?:```|~~~)", re.M),
    re.compile(r"!?\[[^\]\n]*\]\((?:[^()\s]*[/.#][^()\s]*)(?:\s+\"[^\"\n]*\")?\)"), re.compile(r"(?:^[ \t]*[-+][ \t]+\S.*\n?){2,}", re.M), re.compile(r"^>[ \t]+\S", re.M), re.compile(r"~~(?=\S)[^~\n]+(?<=\S)~~"),
]
WIKI = [
    re.compile(r"^[ \t]*\{\|", re.M), re.compile(r"^[ \t]*\|\}[ \t]*$", re.M), re.compile(r"^\|-+[ \t]*$", re.M), re.compile(r"'''(?=[^\s'])[^'\n]+'''"), re.compile(r"(?<![\w')\]}])''(?=[^\s'])[^'\n]+''(?!')"), re.compile(r"\[\[(?=[^\[\]\n]*[^\W\d_])[^\[\]\n]+\]\]"),
    re.compile(r"(?<![\\}^_\w{])\{\{\s*[A-Za-z][\w .-]*\|[^{}]*\}\}|(?<![\\}^_\w{])\{\{\s*[A-Za-z][\w .-]{2,}\}\}"), re.compile(r"^={2,6}[ \t]*[^=\n]+?[ \t]*={2,6}[ \t]*$", re.M), re.compile(r"<(?:ref|nowiki)\b[^<>]*>", re.I), re.compile(r"\[https?://\S+ [^\]\n]+\]"),
]


def _is_tag(m: re.Match) -> bool:
    return m.group(2) is None or m.group(2).lower() in ELEMENTS


def _is_entity(m: re.Match) -> bool:
    name = m.group(1)
    return name[0] == "#" or name + ";" in html5


def unescaped(text: str) -> str:
    """Escaped tags become tags, however often they are escaped; a value that holds real tags keeps its entities for the DOM."""
    while True:
        if "&" not in text or any(_is_tag(m) for m in TAG.finditer(text)):
            return text
        plain = html.unescape(text)
        if not any(_is_tag(m) for m in TAG.finditer(plain)) and not (ENTITY.search(plain) and plain != text):
            return text
        text = plain


HEAD = re.compile(r"h[1-6]$")


class Node:
    """An element of the DOM with its density figures."""

    __slots__ = ("tag", "parts", "parent", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: "Node | None"):
        self.tag, self.parent, self.parts = tag, parent, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def dom(text: str) -> tuple[Node, bool]:
    """The tree of a value below a body node, and whether any tag was seen; ends that match nothing are ignored."""
    root, seen = Node("body", None), False
    at, pos, skip = root, 0, ""
    for m in TAG.finditer(text):
        if not _is_tag(m):
            continue
        seen = True
        if pos < m.start() and not skip:
            at.parts.append(html.unescape(text[pos : m.start()]))
        pos = m.end()
        if m.group(2) is None:
            continue
        name = m.group(2).lower()
        if skip:
            if m.group(1) and name == skip:
                skip = ""
            continue
        if m.group(1):
            up = at
            while up is not None and up.tag != name:
                up = up.parent
            if up is not None and up.parent is not None:
                at = up.parent
            continue
        if name in DROPPED:
            skip = name
            continue
        ended, bound = ENDS.get(name, ((), ()))
        up = at
        while ended and up.parent is not None and up.tag not in bound:
            if up.tag in ended:
                at = up.parent
            up = up.parent
        node = Node(name, at)
        at.parts.append(node)
        if name not in VOID and not m.group(4):
            at = node
    if pos < len(text) and not skip:
        at.parts.append(html.unescape(text[pos:]))
    return root, seen


def _ordered(root: Node) -> list[Node]:
    """Parents before children, without recursion."""
    out = [root]
    for node in out:
        out += [p for p in node.parts if isinstance(p, Node)]
    return out


def with_paragraphs(root: Node) -> None:
    """Runs of text and inline elements beside blocks of the body become paragraphs of their own."""
    if not any(isinstance(p, Node) and p.tag in BLOCKS for p in root.parts):
        return
    parts: list = []
    for p in root.parts:
        if isinstance(p, Node) and p.tag in BLOCKS:
            parts.append(p)
            continue
        if not parts or parts[-1].tag != "":
            parts.append(Node("", root))
        parts[-1].parts.append(p)
        if isinstance(p, Node):
            p.parent = parts[-1]
    root.parts = [p for p in parts if p.tag or any(isinstance(x, Node) or x.strip() for x in p.parts)]


def densities(root: Node) -> list[Node]:
    """Composite text density of every node, and the sum of the densities of its children; the nodes, parents first."""
    nodes = _ordered(root)
    for node in reversed(nodes):
        kids = [p for p in node.parts if isinstance(p, Node)]
        node.chars = sum(len(p.strip()) for p in node.parts if isinstance(p, str)) + sum(k.chars for k in kids)
        node.link_chars = node.chars if node.tag == "a" else sum(k.link_chars for k in kids)
        node.link_tags = sum(k.link_tags + (k.tag == "a") for k in kids)
        # the tags inside a unit are structure; only its links weigh on it
        node.tags = node.link_tags if node.tag in UNITS else sum(k.tags + 1 for k in kids)
    link_ratio = root.link_chars / max(root.chars, 1)
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + link_ratio * c + math.e)
            node.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, 1.0 + 1e-9) + 1.0)
    for node in nodes:
        node.total = sum(p.density for p in node.parts if isinstance(p, Node))
    return nodes


def content(root: Node) -> list[Node]:
    """The subtrees that hold the content, in order; parts that the densities drop are taken out of them."""
    with_paragraphs(root)
    nodes = densities(root)
    hidden = {id(root): False}  # below a unit or an inline element nothing is weighed on its own
    for node in nodes[1:]:
        hidden[id(node)] = hidden[id(node.parent)] or node.parent.tag in UNITS or node.parent.tag not in BLOCKS
    weighed = [n for n in nodes if not hidden[id(n)]]
    best = max(weighed, key=lambda n: (n.total, n is root))
    path = {id(best)}
    threshold, up = best.density, best.parent
    while up is not None:
        path.add(id(up))
        threshold, up = min(threshold, up.density), up.parent
    inside = {id(best)}
    dropped: set[int] = set()
    for node in weighed:
        if node.parent is None or id(node) in path or node.tag not in BLOCKS | UNITS | {""}:
            continue
        if id(node.parent) in dropped:
            dropped.add(id(node))
            continue
        if id(node.parent) in inside:
            inside.add(id(node))
        follower = node
        if node.tag in HEADS:  # a heading goes with what follows it
            kin = [p for p in node.parent.parts if isinstance(p, Node)]
            follower = next((k for k in kin[kin.index(node) + 1 :] if k.tag not in HEADS), node)
        linked = follower.link_tags > 0 or follower.tag == "a"
        if follower.density < threshold and (linked or id(node) not in inside and follower.tag not in UNITS and id(node.parent) not in path):
            dropped.add(id(node))
    for node in weighed:
        node.parts = [p for p in node.parts if not (isinstance(p, Node) and id(p) in dropped)]
    return [root]


def render(node: Node) -> str:
    """Text of a subtree, with rows, lists, code and formulas kept recognisable."""
    done: dict[int, str] = {}
    for n in reversed(_ordered(node)):
        parts = [p if isinstance(p, str) else done.pop(id(p)) for p in n.parts]
        if n.tag not in ("pre", "code"):
            parts = [re.sub(r"[ \t\r\f\v\n]+", " ", p) if isinstance(o, str) else p for p, o in zip(parts, n.parts)]
        if n.tag in ("tr",):
            text = "\n" + " | ".join(re.sub(r"\s+", " ", p).strip() for p, o in zip(parts, n.parts) if isinstance(o, Node)) + "\n"
        elif n.tag in ("table", "thead", "tbody", "tfoot", "ul", "ol", "dl", "colgroup"):
            text = "\n" + "".join(p for p, o in zip(parts, n.parts) if isinstance(o, Node) or o.strip()) + "\n"
        else:
            text = "".join(parts)
            if n.tag == "br":
                text = "\n"
            elif n.tag == "li":
                text = "\n- " + text.strip() + "\n"
            elif n.tag == "code" and n.parent is not None and n.parent.tag != "pre":
                text = f"`{text}`" if text else ""
            elif n.tag == "pre":
                text = "\n```\n" + text.strip("\n") + "\n```\n"
            elif n.tag == "sub" and text.strip():
                text = f"_{text.strip()}" if len(text.strip()) == 1 else f"_{{{text.strip()}}}"
            elif n.tag == "sup" and text.strip():
                text = f"^{text.strip()}" if len(text.strip()) == 1 else f"^{{{text.strip()}}}"
            elif HEAD.match(n.tag):
                text = f"\n{'#' * int(n.tag[1])} {text.strip()}\n"
            elif n.tag in BLOCKS or n.tag in ("", "dt", "dd", "caption"):
                text = "\n" + text.strip(" ") + "\n"
        done[id(n)] = text
    return done[id(node)]


def tidy(text: str) -> str:
    """Blank lines and stray indents go; what stands between code fences stays as it is."""
    parts = re.split(r"(```.*?```)", text, flags=re.S)
    parts[::2] = [re.sub(r"\n{2,}", "\n", re.sub(r"[ \t\xa0]+\n", "\n", re.sub(r"\n[ \t]+(?=[^\s-])", "\n", p))) for p in parts[::2]]
    return "".join(parts).strip()


LATEX_ROW = re.compile(r"\s*\\\\(?:\[[^\]]*\])?\s*(?:\\(?:hline|midrule|bottomrule|toprule)\s*)*")


def latex_text(text: str) -> str:
    """LaTeX tables as rows; font commands dropped; formulas stay, between `$`."""
    if re.search(r"\\begin\s*\{(?:tabular|longtable|array)|\\(?:toprule|midrule|hline)", text):
        text = re.sub(r"\\begin\s*\{[^{}]*\}(?:\[[^\]]*\])?(?:\{(?:[^{}]|\{[^{}]*\})*\})?|\\end\s*\{[^{}]*\}", "\n", text)
        text = re.sub(r"\\(?:hline|toprule|midrule|bottomrule)\b|\\cline\{[^{}]*\}", "", LATEX_ROW.sub("\n", text))
        text = re.sub(r"[ \t]*(?<!\\)&[ \t]*", " | ", text)
        text = re.sub(r"\\multi(?:column|row)\{[^{}]*\}\{[^{}]*\}", "", text)
    elif re.search(r"\\begin\s*\{(?:verbatim|lstlisting)", text):
        return re.sub(r"\\begin\s*\{(?:verbatim|lstlisting)\}(?:\[[^\]]*\])?\n?", "```\n", re.sub(r"\\end\s*\{(?:verbatim|lstlisting)\}", "```", text))
    elif re.search(r"\\begin\s*\{(?:itemize|enumerate)", text):
        text = re.sub(r"\\(?:begin|end)\s*\{(?:itemize|enumerate)\}", "", re.sub(r"\s*\\item\b\s*", "\n- ", text))
    text = re.sub(r"\\(?:textbf|textit|emph|text|underline|texttt)\{([^{}]*)\}", r"\1", text)
    text = re.sub(r"\\(?:section|chapter|subsection)\*?\{([^{}]*)\}", r"# \1", text)
    text = re.sub(r"\\\[\s*(.*?)\s*\\\]|\\\(\s*(.*?)\s*\\\)|\$\$\s*(.+?)\s*\$\$", lambda m: f"${next(g for g in m.groups() if g is not None)}$", text, flags=re.S)
    return re.sub(r"\\([%&#_$])", r"\1", text)


def wiki_text(text: str) -> str:
    """Wiki tables as rows, links as their text, quotes of bold and italics dropped."""
    text = re.sub(r"\[\[(?:[^\[\]|\n]*\|)*([^\[\]|\n]+)\]\]", r"\1", text)
    text = re.sub(r"'{2,5}([^'\n]+)'{2,5}", r"\1", text)
    text = re.sub(r"\{\{\s*math\s*\|([^{}]*)\}\}", r"$\1$", text)
    text = re.sub(r"\{\{\s*[\w .-]+\|?([^{}]*)\}\}", r"\1", text)
    text = re.sub(r"^(={2,6})[ \t]*([^=\n]+?)[ \t]*={2,6}[ \t]*$", lambda m: "#" * len(m.group(1)) + " " + m.group(2), text, flags=re.M)
    if re.search(r"^[ \t]*\{\|", text, re.M):
        rows: list[list[str]] = []
        for line in text.split("\n"):
            s = line.strip()
            if s.startswith(("{|", "|}", "|+")):
                continue
            if s.startswith("|-"):
                rows.append([])
            elif s[:1] in "!|" and s:
                cells = [c.strip() for c in re.split(r"\|\||!!", s[1:])]
                if not rows:
                    rows.append([])
                rows[-1] += cells
            elif s and rows and rows[-1]:
                rows[-1][-1] += " " + s
        return "\n".join(" | ".join(r) for r in rows if r)
    return text


def markdown_text(text: str) -> str:
    """Markdown tables as rows; headings, lists and code keep their signs; emphasis and links become their text."""
    text = re.sub(rf"^[ \t]*\|?[ \t]*{RULE}[ \t]*(?:\|[ \t]*{RULE}[ \t]*)*\|?[ \t]*$\n?", lambda m: "" if "|" in m.group(0) else m.group(0), text, flags=re.M)
    text = re.sub(r"^[ \t]*\|(.*)\|[ \t]*$", lambda m: " | ".join(c.strip() for c in m.group(1).split("|")), text, flags=re.M)
    text = re.sub(r"!?\[([^\]\n]*)\]\((?:[^()\s]*[/.#][^()\s]*)(?:\s+\"[^\"\n]*\")?\)", r"\1", text)
    text = re.sub(r"(?<![*\\])\*\*(?=[^\s*])([^*\n]*?)(?<=[^\s*])\*\*(?!\*)", r"\1", text)
    text = re.sub(r"(?<![\w\\])__(?=[^\s_])([^_\n]*?)(?<=[^\s_])__(?!\w)", r"\1", text)
    return re.sub(r"(?<![\w*\\])\*(?=[^\s*])([^*\n{}\\]*?)(?<=[^\s*])\*(?![\w*])", r"\1", text)


def text_nodes(root: Node) -> str:
    """The texts of all nodes of a parse, each on a line of its own."""
    out: list[str] = []
    stack: list = [root]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        else:
            stack += reversed(part.parts)
    return "\n".join(out)


def read(value: str) -> tuple[str, list[str]]:
    """(clean text, kinds of markup) of one value."""
    kinds, text, plain = [], value, value
    if "<" in value or "&" in value:
        entity = any(_is_entity(m) for m in ENTITY.finditer(value))
        root, tags = dom(unescaped(value))
        if tags or entity:
            kinds.append("html")
            plain = text_nodes(root)
            text = tidy("\n".join(render(n) for n in content(root)))
    for kind, patterns, rewrite in (("latex", LATEX, latex_text), ("wiki", WIKI, wiki_text), ("markdown", MARKDOWN, markdown_text)):
        if any(p.search(plain) for p in patterns):
            kinds.append(kind)
            text = rewrite(text)
    return tidy(text), kinds


def _read_array(values: pa.Array) -> pa.Array:
    texts, kinds = [], []
    for v in values.to_pylist():
        t, k = (None, []) if v is None else read(v)
        texts.append(t)
        kinds.append(k)
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(kinds, pa.list_(pa.string()))], ["text", "kinds"])


def cleaned(col: Column | str) -> Column:
    """struct(text string, kinds array<string>) of a string column."""
    from pyspark.sql.functions import arrow_udf

    def run(values: pa.Array) -> pa.Array:
        return _read_array(values)

    return arrow_udf(run, "text string, kinds array<string>")(F.col(col) if isinstance(col, str) else col)


def fields(blocks: DataFrame) -> DataFrame:
    """(block_id, field, value) of every `table_body` and `math_content` text, wherever in the item it stands; a list there is no text.

    The text filter only spares the parser items that can't hold either key (an escaped key keeps its row).
    """
    item = F.col("item")
    held = blocks.where(item.contains("table_body") | item.contains("math_content") | item.contains("\\u"))
    found = triples(held, "block_id", "item", keys=("table_body", "math_content"), elements=False)
    return found.where(F.col("value").isNotNull() & (F.col("kind") == "string")).select(F.col("rec_id").alias("block_id"), F.col("key").alias("field"), "value")


#: A value without any of these signs holds no markup and is not parsed.
SIGNS = r"[<&\\*_`|\[\](){}$^#=~>'+-]"


def markup_kinds(blocks: DataFrame) -> DataFrame:
    """(block_id, field, markup): one row for each kind of markup that a field's values hold."""
    return fields(blocks).where(F.col("value").rlike(SIGNS)).select("block_id", "field", F.explode(cleaned("value")["kinds"]).alias("markup")).distinct()


def clean_fields(blocks: DataFrame) -> DataFrame:
    """(block_id, field, value_no, text): the clean text of every field; a block delivered twice counts once."""
    one = fields(blocks).distinct()
    return one.select("block_id", "field", F.xxhash64("value").alias("value_no"), cleaned("value")["text"].alias("text"))
