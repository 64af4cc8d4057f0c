"""Cards of a page: an ordered array of ids, looked up, labelled and joined to one text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.functions.text import zero_pad
from cadastre.operators.lookup import array_lookup, dimension_lookup, ordered_concat


def page_cards(
    pages: DataFrame,
    page: str,
    ids: str,
    blocks: DataFrame,
    block: str,
    title: str,
    layers: DataFrame,
    layer: str,
    layer_name: str) -> DataFrame:
    """``(page, cards)``: per page its blocks in array order, each as ``[NN title (layer)]``.

    ``blocks`` has one row per ``block`` with ``title`` and ``layer``; ``layers`` names the layers.
    A block that does not exist has no card.
    """
    items = array_lookup(pages, ids, blocks, block, [page]).filter("NOT is_missing")
    items = dimension_lookup(items, layers.select(layer, layer_name), [layer])
    card = F.concat(
        F.lit("["), zero_pad("position"), F.lit(" "), F.col(title).cast("string"), F.lit(" ("),
        F.col(layer_name), F.lit(")]"),
    )
    return ordered_concat(items, [page], "position", card, "cards")
