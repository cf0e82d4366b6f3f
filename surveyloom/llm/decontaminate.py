"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

A seed mask picks some positions of a span of tokens and ignores the others, so
a substituted word at an ignored position does not hide a match. Every position
of every document is hashed under every mask and joined with the same hashes of
the benchmark items. A hit fixes an alignment; each distinct alignment is then
compared token by token, once, and counts if some run of ``overlap`` tokens agrees
in at least ``agree`` of them.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import cut_lineage, quote

#: Seed masks by (tokens of a run, how many may differ): 1 = the token counts, 0 = it may differ.
#: Whichever tokens differ, one mask fits between or over them (a test enumerates all places).
MASKS = {
    (13, 2): ("11101111", "1111010011", "110100101011"),
    (12, 2): ("11101011", "101100111", "111111"),
    (11, 2): ("1101111", "111100011", "1100011011"),
    (10, 2): ("111011", "11010011", "11111"),
    (9, 1): ("1111011", "1101111"),
    (8, 1): ("111111", "1111011", "1101111"),
    (7, 1): ("11111", "111011", "110111"),
    (6, 1): ("1111", "11011"),
    (5, 1): ("1111", "11101", "11011", "10111"),
}
#: Rows (seeds, items or alignments) that may be sent to every task; about 100 bytes each.
BROADCAST_ROWS = 200_000
# Scripts written without blanks between words.
UNSPACED = "[\\\\p{IsHan}\\\\p{IsHiragana}\\\\p{IsKatakana}\\\\p{IsThai}\\\\p{IsLao}\\\\p{IsKhmer}\\\\p{IsMyanmar}]"


def tokens(text: str = "text") -> str:
    """SQL text: lower-cased runs of letters and digits; each character of an unspaced script is a token."""
    low = f"lower(coalesce({text}, ''))"
    spaced = f"if({low} rlike '{UNSPACED}', regexp_replace({low}, '({UNSPACED})', ' $1 '), {low})"
    return f"array_remove(split({spaced}, '[^\\\\p{{L}}\\\\p{{N}}]+'), '')"


def seed_masks(run: int, agree: float) -> tuple[str, ...]:
    """Masks of which one fits every run of ``run`` tokens that agrees in a share of ``agree``.

    Where none are listed it is the longest stretch that must be free of differences.
    """
    differ = min(run - math.ceil(agree * run), run - 1)
    return MASKS.get((run, differ)) or ("1" * -(-(run - differ) // (differ + 1)),)


def seed_hash(words: str, at: str, mask: str, kind: int) -> str:
    """SQL text: the hash of the tokens that ``mask`` picks from ``at`` (1-based) on; null past the end."""
    picked = ", ".join(f"{words}[{at} + {i - 1}]" for i, bit in enumerate(mask) if bit == "1")
    return f"if({at} + {len(mask) - 1} <= size({words}), xxhash64({kind}, {picked}), null)"


def positions(rows: DataFrame, words: str, masks: Mapping[str, str], *keep: str) -> DataFrame:
    """(keep…, pos, h) for every position of the token arrays and every mask whose condition holds."""
    at = rows.where(f"size({words}) > 0").selectExpr(*keep, words, f"explode(sequence(1, size({words}))) as pos")
    kinds = ", ".join(f"if({when}, {seed_hash(words, 'pos', mask, i)}, null)" for i, (mask, when) in enumerate(masks.items()))
    return at.selectExpr(*keep, words, "pos", f"stack({len(masks)}, {kinds}) as h").where("h is not null")


def item_tokens(items: DataFrame, *, item_id: str, text: str) -> DataFrame:
    """(item, members, item_words): items of equal tokens are one class, named by the smallest id."""
    rows = items.select(quote(item_id).alias("item"), quote(text).alias("text")).selectExpr("item", f"{tokens()} as item_words")
    return (
        rows.where("item is not null and size(item_words) > 0")
        .groupBy("item_words")
        .agg(F.min("item").alias("item"), F.count("*").alias("members"))
    )


def verified(hits: DataFrame, overlap: int, agree: float) -> DataFrame:
    """Distinct hits (words, item_words, start) with n_aligned, n_matched and best run; weak ones go.

    Work in proportion to the item's tokens times ``overlap``.
    """
    run = f"least(size(item_words), {overlap})"
    # The document's token at an item's place; none before its start or past its end.
    same = "int(if(start + {j} < 2, null, get(words, start + {j} - 2)) <=> item_words[{j} - 1])"
    within = f"aggregate(sequence(0, {run} - 1), 0, (a, k) -> a + {same.format(j='(i + k)')})"
    best = f"array_max(transform(sequence(1, size(item_words) - {run} + 1), i -> {within}))"
    return (
        hits.selectExpr("*", f"{best} as best_run")
        .where(f"best_run >= ceil({agree}D * {run})")
        .selectExpr(
            "doc_id", "item", "start", "best_run", "size(item_words) as n_item",
            f"aggregate(sequence(1, size(item_words)), 0, (a, j) -> a + {same.format(j='j')}) as n_matched",
            "least(size(words), start + size(item_words) - 1) - greatest(1, start) + 1 as n_aligned",
        )
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    overlap: int = 13,
    agree: float = 0.8,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(doc_id, item_id, members, start, n_item, n_aligned, n_matched, coverage), the best alignment of each pair.

    ``start`` is the token of the document (from 0; negative if the item begins
    before it) where the item's first token falls. An item shorter than
    ``overlap`` counts as one run of its own length, so one under five tokens must
    stand whole; one without tokens finds nothing. Items of equal tokens are one
    class: its smallest id, and how many members it has. Null texts hold nothing;
    rows without an id are left out; a doc_id of several rows counts if any of
    them matches. Seeds and alignments are broadcast up to ``broadcast_rows`` of
    them, counted, and shuffled beyond.
    """
    classes = item_tokens(items, item_id=item_id, text=item_text)
    run = f"least(size(item_words), {overlap})"
    lengths = defaultdict(list)
    for n in sorted(r.n for r in classes.selectExpr(f"{run} as n").distinct().collect()):
        for mask in seed_masks(n, agree):
            lengths[mask].append(str(n))
    if not lengths:  # no items: any mask finds nothing
        lengths["1"].append("0")
    own = {mask: f"{run} in ({', '.join(of)})" for mask, of in lengths.items()}
    rows = docs.select(quote(doc_id).alias("doc_id"), quote(text).alias("text")).where("doc_id is not null")
    rows = rows.selectExpr("doc_id", f"{tokens()} as words")
    seeds = positions(classes, "item_words", own, "item").selectExpr("h", "item", "pos as item_pos")
    seeds = seeds.groupBy("h", "item").agg(F.collect_set("item_pos").alias("at")).selectExpr("h", "item", "explode(at) as item_pos")
    small = lambda table, n: F.broadcast(table) if n <= broadcast_rows else table
    at = positions(rows, "words", dict.fromkeys(own, "true"), "doc_id").select("doc_id", "pos", "h")
    hits = at.join(small(seeds, seeds.count()), "h").selectExpr("doc_id", "item", "pos - item_pos + 1 as start")
    hits = cut_lineage(hits.distinct())  # all seeds of one copy have one start
    n_hits, n_items = hits.count(), classes.count()
    # Only the documents that were hit are cut into tokens again.
    found = docs.select(quote(doc_id).alias("doc_id"), quote(text).alias("text")).join(small(hits, n_hits), "doc_id")
    found = found.selectExpr("doc_id", "item", "start", f"{tokens()} as words")
    hits = found.join(small(classes.select("item", "item_words"), n_items), "item")
    best = F.expr("max_by(struct(start, n_item, n_aligned, n_matched), struct(n_matched, best_run, -start))")
    pairs = verified(hits, overlap, agree).groupBy("doc_id", "item").agg(best.alias("b"))
    return pairs.join(classes.select("item", "members"), "item").selectExpr(
        "doc_id", "item as item_id", "members", "b.start - 1 as start", "b.n_item as n_item", "b.n_aligned as n_aligned",
        "b.n_matched as n_matched", "b.n_matched / b.n_item as coverage",
    )
