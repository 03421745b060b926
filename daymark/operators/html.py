"""Table rows from stored HTML pages, with built-in expressions only.

Rows of flat tables are cut by patterns. Pages with a table inside a table go another way: their
tags become a sequence that is folded with a stack of open tables, so that each cell belongs to the
row that is open at its depth. The rows of a nested table follow the row that holds it, as in a
browser; the holding cell has its own text, before and after the nested table, and the cells behind
it are the outer row's. Text hidden by styles shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions import cell_text, let


def _until(*stops: str) -> str:
    """Everything up to a "<" that begins one of the stops, or to the end of the text.

    Possessive, so it takes one pass and no stack, however long the text is.
    """
    return rf"[^<]*+(?:<(?!{'|'.join(stops)})[^<]*+)*+"


def _whole(*tags: str) -> str:
    """Elements of these tags after their "<"; one never closed runs to the end, as in a browser."""
    return "|".join(rf"{tag}\b{_until(rf'/{tag}')}(?:</{tag}[^>]*>|\z)" for tag in tags)


INVISIBLE = rf"(?is)<(?:!--.*?(?:-->|\z)|{_whole('script', 'style')})"
SECTION = r"t(?:head|body|foot)[\s>]"
NOT_BODY = rf"(?is)<t(?:head|foot)\b{_until(SECTION, '/t(?:head|foot|able)')}"
PAGES_PER_BLOCK = 10_000


def _inner(tag: str, *ends: str) -> str:
    """Content of ``<tag ...>``, up to its end tag, one of ``ends``, or the end of the text."""
    return rf"(?is)<{tag}(?:\s[^>]*)?>({_until(rf'/{tag}[\s>]', *ends)})"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _bodies(html: Column) -> Column:
    """What is left of the tables without their heads and feet."""
    return F.regexp_replace(F.regexp_extract(html, r"(?is)<table[\s>].*", 0), NOT_BODY, "")


# Where a table begins before the one that is open has ended.
NESTED = rf"(?is)<table[\s>]{_until(r'/?table[\s>]')}<table[\s>]"
# Begins at every tag that tables are made of.
PIECES = r"(?i)(?=</?(?:table|thead|tbody|tfoot|tr|td|th)[\s/>])"
ROW_MARK = "\ue000"  # a private character, which pages don't have
TOKENS_PER_CHUNK = 256
OPEN_TABLE = "struct<row:int,cell:boolean,body:boolean>"


def _step(state: Column, tag: Column, bodies_only: bool) -> Column:
    """(tables, next, row) after a tag: the open tables, the number of the next row, and the row
    that the tag and the text behind it belong to, -1 for none.

    An open table has its open row, whether a cell is open, and whether rows count here.
    """
    tables, following = state["tables"], state["next"]
    none = F.lit(-1)
    last = F.try_element_at(tables, F.lit(-1))
    outer = F.slice(tables, 1, F.greatest(F.size(tables) - 1, F.lit(0)))

    def table(row: Column, cell: bool | Column, body: Column) -> Column:
        cell = F.lit(cell) if isinstance(cell, bool) else cell
        return F.struct(row.alias("row"), cell.alias("cell"), body.alias("body"))

    def after(new: Column, row: Column, number: Column = following) -> Column:
        return F.struct(new.alias("tables"), number.alias("next"), row.alias("row"))

    def instead(new: Column) -> Column:
        return F.concat(outer, F.array(new))

    fresh = table(none, False, F.lit(True))
    ended = F.try_element_at(outer, F.lit(-1))
    counts = last["body"] if bodies_only else F.lit(True)
    cell_row = F.coalesce(last["row"], none)
    return (
        # A table outside the cells of the open one ends that one.
        F.when(
            (tag == "table") & (F.size(tables) > 0) & ~last["cell"], after(instead(fresh), none)
        )
        .when(tag == "table", after(F.concat(tables, F.array(fresh)), none))
        .when(
            tag == "/table",
            after(outer, F.when(ended["cell"], ended["row"]).otherwise(none)),
        )
        .when(F.size(tables) == 0, after(tables, none))
        .when(tag.isin("thead", "tfoot"), after(instead(table(none, False, F.lit(False))), none))
        .when(tag.isin("tbody", "/thead", "/tbody", "/tfoot"), after(instead(fresh), none))
        .when((tag == "tr") & counts, after(instead(table(following, False, last["body"])), following, following + 1))
        .when(tag.isin("tr", "/tr"), after(instead(table(none, False, last["body"])), none))
        .when(tag.isin("td", "th"), after(instead(table(last["row"], True, last["body"])), cell_row))
        .when(tag.isin("/td", "/th"), after(instead(table(last["row"], False, last["body"])), cell_row))
        .otherwise(after(tables, none))
    )


def _row_of_each(tags: Column, bodies_only: bool) -> Column:
    """The row that each tag belongs to, by a fold over the tags, chunk by chunk.

    Chunks keep the arrays short that grow by one at each step.
    """
    nothing = F.array().cast(f"array<{OPEN_TABLE}>")

    def within(state: Column, tag: Column) -> Column:
        return let(
            _step(state, tag, bodies_only),
            lambda s: F.struct(
                s["tables"].alias("tables"),
                s["next"].alias("next"),
                F.concat(state["rows"], F.array(s["row"])).alias("rows"),
            ),
        )

    def over(state: Column, k: Column) -> Column:
        begin = F.struct(
            state["tables"].alias("tables"),
            state["next"].alias("next"),
            F.array().cast("array<int>").alias("rows"),
        )
        chunk = F.slice(tags, k * TOKENS_PER_CHUNK + 1, TOKENS_PER_CHUNK)
        return let(
            F.aggregate(chunk, begin, within),
            lambda s: F.struct(
                s["tables"].alias("tables"),
                s["next"].alias("next"),
                F.concat(state["chunks"], F.array(s["rows"])).alias("chunks"),
            ),
        )

    begin = F.struct(
        nothing.alias("tables"),
        F.lit(0).alias("next"),
        F.array().cast("array<array<int>>").alias("chunks"),
    )
    chunks = F.sequence(F.lit(0), F.floor((F.size(tags) - 1) / TOKENS_PER_CHUNK).cast("int"))
    return F.aggregate(chunks, begin, over, lambda s: F.flatten(s["chunks"]))


def _nested_rows(html: Column, bodies_only: bool) -> Column:
    """The rows of a page with nested tables as markup, each with its own cells only."""

    def rows(pieces: Column) -> Column:
        tags = F.transform(pieces, lambda p: F.lower(F.regexp_extract(p, r"^<(/?[A-Za-z]+)", 1)))
        return let(tags, lambda t: let(_row_of_each(t, bodies_only), lambda r: sorted_rows(pieces, t, r)))

    def sorted_rows(pieces: Column, tags: Column, row: Column) -> Column:
        def text(piece: Column, tag: Column) -> Column:
            return F.when(tag == "tr", F.concat(F.lit(ROW_MARK), piece)).when(
                tag == "/table", F.regexp_replace(piece, r"^<[^>]*>", " ")
            ).otherwise(piece)

        own = F.transform(
            pieces,
            lambda piece, i: F.struct(
                row[i].alias("row"), i.alias("i"), text(piece, tags[i]).alias("text")
            ),
        )
        # By row, and within a row in page order.
        kept = F.array_sort(F.filter(own, lambda x: x["row"] >= 0))
        joined = F.array_join(F.transform(kept, lambda x: x["text"]), "")
        # Before the first mark there is nothing.
        return let(F.split(joined, ROW_MARK), lambda x: F.slice(x, 2, F.size(x)))

    return let(F.split(F.translate(html, ROW_MARK, ""), PIECES), rows)


def html_table_rows(
    df: DataFrame,
    html_col: str = "html",
    row_tag: str = "tr",
    cell_tag: str = "td",
    bodies_only: bool = True,
) -> DataFrame:
    """One row per table row: ``row_pos`` from 0 within the page, ``cells`` as trimmed texts.

    A row without cells has an empty array. ``bodies_only`` leaves out rows in table
    heads and feet; turn it off for rows that are not in tables. The other columns
    of ``df`` are kept, the page text is not.
    """
    visible = F.regexp_replace(html_col, INVISIBLE, "")
    row = _inner(row_tag, rf"{row_tag}[\s>]")
    # A head cell ends a cell, too.
    cell = _inner(cell_tag, r"t[dh][\s>]" if cell_tag == "td" else rf"{cell_tag}[\s>]")
    rows = _all(_bodies(visible) if bodies_only else visible, row)
    if row_tag == "tr":
        rows = F.when(F.col(html_col).rlike(NESTED), _nested_rows(visible, bodies_only)).otherwise(rows)
    kept = [c for c in df.columns if c != html_col]
    # Cells are cut after the explode, so a plan that only counts rows does not cut them.
    return df.select(*kept, F.posexplode(rows).alias("row_pos", "_row")).select(
        *kept,
        "row_pos",
        F.transform(_all(F.col("_row"), cell), cell_text).alias("cells"),
    )


def concat_pages(
    df: DataFrame,
    capture_col: str,
    page_col: str,
    pos_col: str = "row_pos",
    pages_per_block: int = PAGES_PER_BLOCK,
) -> DataFrame:
    """Number the rows of each capture from 1 in page order, as ``row_no``.

    ``pos_col`` counts the rows of a page from 0, and the page column is a number. Where
    rows were filtered out, their numbers stay free. No row is sorted: a row's number is
    its position plus the extents of earlier pages, summed first within blocks of
    pages and then over blocks, so one capture of very many pages is spread too.
    """
    pages = (
        df.groupBy(F.col(capture_col).alias("_capture"), F.col(page_col).alias("_page"))
        .agg((F.max(pos_col) + F.lit(1).cast("long")).alias("_rows"))
        .withColumn("_block", F.floor(F.col("_page") / pages_per_block))
    )
    blocks = pages.groupBy("_capture", "_block").agg(F.sum("_rows").alias("_block_rows"))

    def sum_before(col: str, partition: list[str], order: str) -> Column:
        window = Window.partitionBy(*partition).orderBy(order)
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(col).over(earlier), F.lit(0))

    blocks = blocks.select(
        F.col("_capture").alias("_block_capture"),
        F.col("_block").alias("_block_no"),
        sum_before("_block_rows", ["_capture"], "_block").alias("_before_block"),
    )
    pages = (
        pages.withColumn("_before_page", sum_before("_rows", ["_capture", "_block"], "_page"))
        .join(
            blocks,
            F.col("_capture").eqNullSafe(F.col("_block_capture"))
            & F.col("_block").eqNullSafe(F.col("_block_no")),
        )
        .select("_capture", "_page", (F.col("_before_block") + F.col("_before_page")).alias("_before"))
    )
    return df.join(
        pages,
        F.col(capture_col).eqNullSafe(F.col("_capture"))
        & F.col(page_col).eqNullSafe(F.col("_page")),
    ).select(*df.columns, (F.col("_before") + F.col(pos_col) + 1).alias("row_no"))
