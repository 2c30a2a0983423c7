"""Links, headings and table cells of one page, as array expressions.

A page is one value, so everything found in it is bounded by that value and is
worked on in place: no page is exploded, regrouped or shuffled to be read.
Rows and cells are cut at their opening tags, so missing closing tags do no
harm. A table reaches to the closing tag of its own depth: what lies in a table
inside it belongs to both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import SPACE, bind, first_index, strip, strip_shirt_number

# Possessive groups throughout: the engine repeats any other group by recursion, once per attribute.
REST = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
# Each pattern starts with a plain "<", so the search skips from tag to tag.
HIDDEN = r"(?s)<(?:!--.*?-->|(?i:script)\b.*?</(?i:script)\s*>|(?i:style)\b.*?</(?i:style)\s*>)"
ANY_TAG = r"(?s)<(?:/?[a-zA-Z]" + REST + r"|[!?][^>]*>)"
ANCHOR = r"(?s)<[aA](?=[\s>])" + REST + r".*?(?:</[aA]\s*>|\z)"
OPENING = r"(?is)^<[a-z0-9]+" + REST
VALUE = r"""(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
HEADING = r"(?s)<[hH]1(?=[\s>])" + REST + r"(.*?)(?:</[hH]1\s*>|\z)"
ENTITY = r"(?s)&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?|[^&]+|&"

ENTITIES = {name: chr(code) for name, code in name2codepoint.items()}
UNKNOWN = "\ufffd"
CUT = "\x00"  # taken out of a page before anything is cut there


def cut_at(text: Column, pattern: str) -> Column:
    """Split at a pattern: the engine keeps the compiled pattern of a replace, not of a split."""
    return F.split(F.regexp_replace(text, pattern, CUT), CUT)


def _character(code: Column) -> Column:
    """The character of a code point; 128-159 are read as Windows-1252, as browsers do."""
    legacy = "".join(bytes([n]).decode("cp1252", "replace") for n in range(128, 160))
    old = F.substr(F.lit(legacy), (code - 127).cast("int"), F.lit(1))
    wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.between(128, 159) & (old != UNKNOWN), old)
        .when((code > 0) & (code < 0x110000), wide)
        .otherwise(F.lit(UNKNOWN))
    )


def unescape(value: Column, names: dict[str, str] = ENTITIES) -> Column:
    """Character references to characters; an unknown name keeps its ``&name``.

    ``names`` may be widened to ``{k.rstrip(';'): v for k, v in html.entities.html5.items()}``.
    """
    table = F.map_from_arrays(
        F.split(F.lit("\t".join(names)), "\t"), F.split(F.lit("\t".join(names.values())), "\t")
    )

    def reference(body: Column) -> Column:
        digits = F.when(
            body.rlike("^#[xX]"), F.conv(F.substr(body, F.lit(3)), 16, 10)
        ).when(body.startswith("#"), F.substr(body, F.lit(2)))
        return (
            F.when(body == "amp", F.lit("&"))
            .when(body.startswith("#"), bind(digits.try_cast("bigint"), _character))
            .otherwise(F.coalesce(F.try_element_at(table, body), F.concat(F.lit("&"), body)))
        )

    def decoded(token: Column) -> Column:
        plain = (F.length(token) == 1) | ~token.startswith("&")
        return F.when(plain, token).otherwise(
            bind(F.regexp_replace(token, "^&|;$", ""), reference)
        )

    def whole(text: Column) -> Column:
        tokens = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
        return F.when(~F.contains(text, F.lit("&")), text).otherwise(
            F.array_join(F.transform(tokens, decoded), "")
        )

    return bind(value, whole)


def visible(html: Column) -> Column:
    """The page without NUL, comments, scripts and styles; the cut leaves a tag, so texts stay apart."""
    return F.regexp_replace(F.replace(html, F.lit(CUT), F.lit("")), HIDDEN, "<!>")


def text_of(fragment: Column) -> Column:
    """All text pieces, each stripped, joined by one blank."""

    def stripped(text: Column) -> Column:
        clear = F.ascii(text).between(33, 126) & F.ascii(F.right(text, F.lit(1))).between(33, 126)
        return F.when(clear, text).otherwise(strip(text))

    def whole(text: Column) -> Column:
        pieces = F.transform(
            F.transform(cut_at(text, ANY_TAG), lambda piece: unescape(piece)), stripped
        )
        plain = ~F.contains(text, F.lit("<")) & ~F.contains(text, F.lit("&"))
        return F.when(plain, stripped(text)).otherwise(
            F.array_join(F.filter(pieces, lambda piece: piece != ""), " ")
        )

    return bind(fragment, whole)


def attributes(opening: Column, *names: str) -> Column:
    """struct of attributes of an opening tag: '' without a value, null when absent; the last of a name counts."""

    def value(pair: Column) -> Column:
        given = F.regexp_extract(pair, r"(?s)=\s*(.*)\z", 1)
        return unescape(F.regexp_replace(given, r"""(?s)^(["'])(.*)\1\z""", "$2"))

    def named(name: str) -> Column:
        # every attribute is gone over, so that none begins inside a value; only those of the name are caught
        own = rf"""(?s)((?i:{name})(?![^\s"'<>/=]){VALUE})|[^\s"'<>/=]+{VALUE}"""
        same = F.array_remove(F.regexp_extract_all(opening, F.lit(own), F.lit(1)), "")
        return bind(F.try_element_at(same, F.lit(-1)), value)

    return F.struct(*[named(name).alias(name) for name in names])


def attribute(anchor: Column, name: str) -> Column:
    """One attribute of what ``links`` has as an anchor."""
    return bind(F.regexp_extract(anchor, OPENING, 0), lambda opening: attributes(opening, name)[name])


def links(html: Column, *names: str) -> Column:
    """array<struct<pos, href, title, anchor>> in document order; ``text_of`` an anchor is its text.

    With ``names`` the attributes are those: each takes a search of its own.
    """
    wanted = names or ("href", "title")

    def parsed(anchor: Column, position: Column) -> Column:
        return bind(
            bind(F.regexp_extract(anchor, OPENING, 0), lambda opening: attributes(opening, *wanted)),
            lambda found: F.struct(position.alias("pos"), *[found[name].alias(name) for name in wanted], anchor.alias("anchor")),
        )

    return F.transform(F.regexp_extract_all(visible(html), F.lit(ANCHOR), F.lit(0)), parsed)


def anchors(html: Column) -> Column:
    """array<struct<pos, href, title, text>> in document order."""
    return F.transform(
        links(html), lambda a: F.struct(a["pos"], a["href"], a["title"], text_of(a["anchor"]).alias("text"))
    )


def page_heading(page: Column) -> Column:
    return strip_shirt_number(text_of(F.regexp_extract(page, HEADING, 1)))


def heading(html: Column) -> Column:
    """Text of the first ``<h1>``, without a leading shirt number; null where there is none."""
    return page_heading(visible(html))


# --- tables -------------------------------------------------------------------------
#
# A page's tables are read as one text: a few replaces over the whole page leave its marks (tables, rows and
# cells) and the clean texts behind them, and only then is it split. What is done for every cell would be
# done by Spark's interpreter, not by generated code or a pattern. In that text every sign is NUL and a
# letter: a, r and d for the marks (with a slash before it where they close), - for any other tag.

MARK = r"<(?=/?[tT](?:[dDrR]|[aA][bB][lL][eE])[\s>])"
WITHIN = r"""[^>"'\x00]*+(?:"[^"\x00]*+"[^>"'\x00]*+|'[^'\x00]*+'[^>"'\x00]*+)*+>"""  # REST up to the next mark
#: A mark and its tag; where the tag has no end, all up to the next mark.
SIGN = r"(?s)\x00(/?)[tT]([aArRdD])(?:" + WITHIN + r"|[^\x00]*+)"
OTHER_TAG = r"(?s)<(?:/?[a-zA-Z]" + WITHIN + r"|[!?][^>\x00]*+>)"
BLANK = "(?:" + SPACE + r"|\x00-)"
SPACE_OR_SIGN = SPACE[:-1] + r"\x00]"
# A run of blanks is tried once, from its first one.
RUN = f"(?={SPACE_OR_SIGN})(?<!{SPACE})"
LEADING = r"(\x00/?[aArRdD])" + BLANK + "++"
TRAILING = RUN + r"(?<!\x00-)" + BLANK + r"++(?=\x00|\z)"
BETWEEN = RUN + SPACE + r"*+\x00-" + BLANK + "*+"
TABLES, ROWS, CELLS = r"\x00[aA]", r"\x00[rR]", r"\x00[dD]"
#: A table mark with another one before anything closes a table.
IN_TABLE = TABLES + r"[^\x00]*+(?:\x00(?!/?[aA])[^\x00]*+)*+\x00[aA]"
#: A mark's kind is where its letters stand here.
KINDS = "a,r,d,/a,/r,/d"
TABLE, ROW, CELL, END_TABLE, END_ROW, END_CELL = (("," + KINDS).index("," + kind) + 1 for kind in KINDS.split(","))


def _signs(page: Column) -> Column:
    """The page from its first mark on, marks as signs."""
    marked = F.regexp_extract(F.regexp_replace(page, MARK, CUT), r"(?s)\x00.*", 0)
    return F.regexp_replace(marked, SIGN, CUT + "$1$2")


def _clean(signs: Column) -> Column:
    """The texts behind the marks as ``text_of`` has them."""
    decoded = unescape(F.regexp_replace(signs, OTHER_TAG, CUT + "-"))
    outer = F.regexp_replace(F.regexp_replace(decoded, LEADING, "$1"), TRAILING, "")
    return F.regexp_replace(outer, BETWEEN, " ")


def _behind(text: Column, pattern: str) -> Column:
    """What stands behind each place that matches."""
    return bind(F.split(text, pattern), lambda all_: F.slice(all_, F.lit(2), F.size(all_)))


def _side_by_side(signs: Column) -> Column:
    """Tables of a page whose tables do not lie in each other, as texts of rows; cells as they are written.

    A cell ends at the next mark, a row at the next mark that is no cell's, a table at the next table's.
    What lies outside all of them is dropped first.
    """
    cells = F.regexp_replace(signs, r"\x00/[dD][^\x00]*+", "")
    bare = F.regexp_replace(cells, r"(\x00/?[aArR])[^\x00]*+", "$1")
    in_rows = F.regexp_replace(bare, r"(\x00(?:/[aArR]|[aA]))(?:\x00[dD][^\x00]*+)++", "$1")
    in_tables = F.regexp_replace(in_rows, r"\x00/(?:[rR]|[aA](?:\x00/?[rRdD][^\x00]*+)*+)", "")
    return _behind(_clean(in_tables), TABLES)


def _marks(signs: Column) -> Column:
    """array<struct<k, t>>: kind of each mark, and the text behind it.

    Left out is what closes nothing more than the mark right behind it does.
    """
    cells = F.regexp_replace(_clean(signs), r"\x00/[dD](?=\x00(?:/?[rRdD]|/[aA]))", "")
    rows = F.regexp_replace(cells, r"\x00/[rR](?=\x00(?:/?[rR]|/[aA]))", "")

    def mark(piece: Column) -> Column:
        letters = F.when(piece.startswith("/"), F.left(piece, F.lit(2))).otherwise(F.left(piece, F.lit(1)))
        return bind(
            letters,
            lambda kind: F.struct(
                F.instr(F.lit(KINDS), F.lower(kind)).alias("k"), F.substr(piece, F.length(kind) + 1).alias("t")
            ),
        )

    return F.transform(_behind(rows, CUT), mark)


#: Closed cells, rows and tables that are gathered before they are put away: a longer array is copied less often.
GATHERED = 256


def _nested(marks: Column) -> Column:
    """Cells, rows and tables of any page: one walk over its marks with the chain of open tables.

    Of the innermost table the open row and cell are known, and of those around it, whatever was open
    where the inner one began. A cell keeps the number of texts before it, a row that of cells, a
    table that of rows; what a mark closes gets the number at its end.
    """
    open_ = ["table", "from_row", "row", "from_cell", "cell", "from_text"]
    chain = f"struct<{','.join(f'{name}:int' for name in open_)}>"
    done = "struct<k:int,id:int,first:int,last:int>"
    nothing = F.lit(None).cast("int")

    def ended(now: Column, texts: Column, cells: Column, rows: Column, upto: Column) -> Column:
        """Of what is open, the cell (``upto`` 1), the row as well (2), the table as well (3)."""

        def one(kind: str, level: int, number: str, first: str, last: Column) -> Column:
            entry = F.struct(F.lit(kind).alias("k"), now[number].alias("id"), now[first].alias("first"), last.alias("last"))
            return F.when((upto >= level) & now[number].isNotNull(), entry.cast(done))

        found = F.array(
            one(CELL, 1, "cell", "from_text", texts), one(ROW, 2, "row", "from_cell", cells), one(TABLE, 3, "table", "from_row", rows)
        )
        return F.filter(found, lambda entry: entry.isNotNull())

    def step(state: Column, mark: Column) -> Column:
        # nothing is bound here: a bound value is copied, and the state grows with the page
        kind, now, around = mark["k"], state["now"], state["around"]
        inside = now["table"].isNotNull()
        upto = F.when(kind == TABLE, 0).when(kind.isin(CELL, END_CELL), 1).when(kind.isin(ROW, END_ROW), 2).otherwise(3)
        closes = (upto >= 1) & now["cell"].isNotNull() | (upto >= 2) & now["row"].isNotNull() | (upto == 3) & inside
        gathered = F.when(
            closes, F.concat(state["gathered"], ended(now, state["texts"], state["cells"], state["rows"], upto))
        ).otherwise(state["gathered"])
        full = F.size(state["gathered"]) >= GATHERED

        def opened(own: str, number: Column, first: str, start: Column, level: int) -> list[Column]:
            new = inside & (kind == own)
            keep = upto < level
            return [
                F.when(new, number).when(keep, now[name]).otherwise(nothing).alias(name) if name != first
                else F.when(new, start).when(keep, now[name]).otherwise(nothing).alias(name)
                for name in ({CELL: "cell", ROW: "row"}[own], first)
            ]

        row, from_cell = opened(ROW, state["rows"], "from_cell", state["cells"], 2)
        cell, from_text = opened(CELL, state["cells"], "from_text", state["texts"], 1)
        within = F.struct(now["table"].alias("table"), now["from_row"].alias("from_row"), row, from_cell, cell, from_text).cast(chain)
        fresh = F.struct(
            state["tables"].alias("table"), state["rows"].alias("from_row"), *[nothing.alias(name) for name in open_[2:]]
        ).cast(chain)
        empty = F.struct(*[nothing.alias(name) for name in open_]).cast(chain)
        more = lambda own, name: state[name] + F.when(inside & (kind == own), 1).otherwise(0)
        return F.struct(
            F.when(kind == TABLE, fresh).when(kind == END_TABLE, F.coalesce(F.try_element_at(around, F.lit(-1)), empty))
            .otherwise(within).alias("now"),
            F.when((kind == TABLE) & inside, F.concat(around, F.array(now)))
            .when((kind == END_TABLE) & (F.size(around) > 0), F.slice(around, F.lit(1), F.size(around) - 1))
            .otherwise(around).alias("around"),
            F.when(full, F.array().cast(f"array<{done}>")).otherwise(gathered).alias("gathered"),
            F.when(full, F.concat(state["put"], F.array(gathered))).otherwise(state["put"]).alias("put"),
            (state["texts"] + F.when(mark["t"] != "", 1).otherwise(0)).alias("texts"),
            more(CELL, "cells").alias("cells"), more(ROW, "rows").alias("rows"),
            (state["tables"] + F.when(kind == TABLE, 1).otherwise(0)).alias("tables"),
        )

    start = F.struct(
        F.struct(*[nothing.alias(name) for name in open_]).cast(chain).alias("now"),
        F.array().cast(f"array<{chain}>").alias("around"), F.array().cast(f"array<{done}>").alias("gathered"),
        F.array().cast(f"array<array<{done}>>").alias("put"),
        *[F.lit(0).alias(c) for c in ("texts", "cells", "rows", "tables")],
    )

    def finish(state: Column) -> Column:
        left = F.transform(
            F.concat(state["around"], F.array(state["now"])),
            lambda now: ended(now, state["texts"], state["cells"], state["rows"], F.lit(3)),
        )
        return F.concat(F.flatten(state["put"]), state["gathered"], F.flatten(left))

    def of(found: Column, texts: Column) -> Column:
        def all_(kind: str) -> Column:
            own = F.filter(found, lambda x: x["k"] == kind)
            return F.array_sort(F.transform(own, lambda x: F.struct(x["id"].alias("id"), x["first"].alias("first"), x["last"].alias("last"))))

        def text(cell: Column) -> Column:
            return F.array_join(F.slice(texts, cell["first"] + 1, cell["last"] - cell["first"]), " ")

        def stretches(kind: str) -> Column:
            return F.transform(
                all_(kind), lambda x: F.struct(x["first"].alias("first"), (x["last"] - x["first"]).alias("size"))
            )

        return F.struct(
            F.transform(all_(CELL), text).alias("cells"), stretches(ROW).alias("rows"), stretches(TABLE).alias("tables")
        )

    def walked(read: Column) -> Column:
        texts = F.transform(F.filter(read, lambda mark: mark["t"] != ""), lambda mark: mark["t"])
        return bind(F.aggregate(read, start, step, finish), lambda found: bind(texts, lambda t: of(found, t)))

    return bind(marks, walked)


@dataclass(frozen=True)
class Apart:
    """``_side_by_side`` of a page: its tables are texts, which are split when they are asked for."""

    found: Column

    def tables(self) -> Column:
        return self.found

    def rows(self, table: Column) -> Column:
        """Rows of one of the tables, as arrays of cell texts."""
        return F.transform(_behind(table, ROWS), lambda row: _behind(row, CELLS))

    def first_table(self, probed: int, wanted: int, least: int, test: Callable[[Column, Column], Column]) -> Column:
        """Zero-based number of the first table of whose first ``probed`` rows ``wanted`` have ``least`` cells and two first that pass."""

        def passes(row: Column) -> Column:  # what is split begins with what stands before the first cell
            return bind(F.split(row, CELLS, least + 2), lambda c: F.when(F.size(c) > least, test(F.get(c, F.lit(1)), F.get(c, F.lit(2)))))

        def enough(rows: Column) -> Column:
            good = F.filter(F.slice(rows, F.lit(2), F.lit(probed)), passes)
            return F.when(F.size(rows) > wanted, F.size(good) >= wanted)

        return first_index(self.found, lambda table: bind(F.split(table, ROWS, probed + 2), enough))


class Inside(Apart):
    """``_nested`` of a page: rows are stretches of its cells and tables of its rows, so that no cell is there twice."""

    def tables(self) -> Column:
        return self.found["tables"]

    def rows(self, table: Column) -> Column:
        def row(row: Column) -> Column:
            return F.slice(self.found["cells"], row["first"] + 1, row["size"])

        return F.transform(F.slice(self.found["rows"], table["first"] + 1, table["size"]), row)

    def first_table(self, probed: int, wanted: int, least: int, test: Callable[[Column, Column], Column]) -> Column:
        """As above; a row is judged once, however many tables it is in."""
        cell = lambda r, n: F.get(self.found["cells"], r["first"] + n)
        judged = F.transform(self.found["rows"], lambda r: F.when(r["size"] >= least, test(cell(r, 0), cell(r, 1))).otherwise(False))

        def first(rows: Column) -> Column:
            tried = lambda t: F.slice(rows, t["first"] + 1, F.least(t["size"], F.lit(probed)))
            return first_index(self.tables(), lambda t: F.size(F.filter(tried(t), lambda is_: is_)) >= wanted)

        return bind(judged, first)


def with_tables(page: Column, use: Callable[[Apart], Column]) -> Column:
    """``use`` of the tables of a visible page, in the order of their opening tags.

    As in the page's tree, rows and cells of a table inside another one are found in both, and an
    outer cell's text has theirs too.
    """

    def of(signs: Column) -> Column:
        apart = bind(_side_by_side(signs), lambda found: use(Apart(found)))
        inside = bind(_nested(_marks(signs)), lambda found: use(Inside(found)))
        return F.when(signs.rlike(IN_TABLE), inside).otherwise(apart)

    return bind(_signs(page), of)


def tables(html: Column) -> Column:
    """array<table: array<row: array<cell text>>> of one page."""
    return with_tables(visible(html), lambda page: F.transform(page.tables(), page.rows))
