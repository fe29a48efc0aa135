"""Operator 11: main text of web pages by a recurrent block labeller.

Tasks read every page into its text blocks (:mod:`html_blocks`) and label all
of them with a bidirectional LSTM over tag-path and hashed-word vectors
(:mod:`block_labeller`); the main blocks' texts in page order, joined by a
space, are the page's text.

The labeller is trained on the driver from a bounded sample of the pages:
at most ``SAMPLE`` pages of at most ``SAMPLE_CHARS`` characters, those of
smallest hash. Sampled pages whose own markup names a main region are labelled
by it; their texts also fill ``DRAWN`` generated layouts (:mod:`html_layouts`)
with menus, notices, adverts, forms and reader comments in many forms. Only the
sample is bounded: every page is read and labelled whole.

Defined cases: null and empty html and pages without text give an empty text
and no blocks; page_id and url are passed on whatever they hold, repeated rows
each keep theirs; a page of any length is read in one pass, its blocks labelled
in spans with the states carried on; an empty table gives an empty result.
Columns other than page_id, url and html are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import ship

SAMPLE = 400
SAMPLE_CHARS = 60_000
DRAWN = 1500
LONGEST = 250  #: blocks of a training page
EPOCHS = 8
SLICE = 4_000_000  #: characters of html read and labelled at a time
THRESHOLD = 0.5
BLOCKS = "array<struct<path:string,text:string,score:float>>"


def sampled(pages: DataFrame, n: int = SAMPLE, most: int = SAMPLE_CHARS) -> list[str]:
    """Html of at most ``n`` pages of at most ``most`` characters: those of smallest hash.

    Hashes above a limit that some 3 ``n`` pages of the table stay under are left in the tasks.
    """
    share = min(1.0, 3 * n / max(1, pages.count()))
    limit = min(2**63 - 1, int(-(2**63) + share * 2**64))
    held = pages.select(F.xxhash64("page_id", "html").alias("by"), "html").where((F.col("by") <= limit) & (F.length("html") <= most))
    return [r["html"] for r in held.orderBy("by").limit(n).collect()]


def training_pages(html: list[str], drawn: int = DRAWN, seed: int = 1):
    """(blocks, labels) of the sample where its markup tells them, and of generated layouts."""
    import numpy as np

    from slotwise.llm.html_blocks import Paths, read
    from slotwise.llm.html_layouts import Layouts, marked, own_label

    paths, out, texts = Paths(), [], []
    for h in html:
        blocks = read(h, paths)[:LONGEST]
        texts += [b.text for b in blocks]
        labels = np.array([own_label(b) for b in blocks], np.float32)
        if len(blocks) and labels.any():
            out.append((blocks, labels))
    layouts = Layouts(texts, np.random.default_rng(seed))
    for _ in range(drawn):
        blocks, labels = marked(layouts.page(), paths)
        if 0 < len(blocks) <= LONGEST:
            out.append((blocks, labels))
    return out


def fitted(html: list[str], seed: int = 1) -> dict:
    """Weights of the labeller from a sample of pages."""
    from slotwise.llm.block_labeller import Features, train

    features = Features()
    pages = training_pages(html, seed=seed)
    return train([features.of(b, 0, len(b)) for b, _ in pages], [y for _, y in pages], seed, EPOCHS)


def label_blocks(pages: DataFrame, weights: dict) -> DataFrame:
    """page_id, url and all blocks of every page with path, text and the probability of being main text."""
    ship(pages.sparkSession)
    kept = pages.select("page_id", "url", "html")
    types = {c: kept.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def slices(column):
        lo = size = 0
        for i, h in enumerate(column):
            if size and size + len(h) > SLICE:
                yield lo, i
                lo, size = i, 0
            size += len(h)
        if lo < len(column):
            yield lo, len(column)

    def read_and_label(batches):
        import pyarrow as pa

        from slotwise.llm.block_labeller import Features, label
        from slotwise.llm.html_blocks import Paths, read

        features, paths = Features(), Paths()
        kind = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("score", pa.float32())]))
        for b in batches:
            html = [h or "" for h in b.column("html").to_pylist()]
            for lo, hi in slices(html):
                found = [read(h, paths) for h in html[lo:hi]]
                scores = label(weights, features, found)
                blocks = [[(x.element.path(), x.text, float(s)) for x, s in zip(xs, ss, strict=True)] for xs, ss in zip(found, scores, strict=True)]
                listed = [[{"path": p, "text": t, "score": s} for p, t, s in page] for page in blocks]
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id").slice(lo, hi - lo), b.column("url").slice(lo, hi - lo), pa.array(listed, kind)], ["page_id", "url", "blocks"])

    return kept.mapInArrow(read_and_label, f"page_id {types['page_id']}, url {types['url']}, blocks {BLOCKS}")


def extract(pages: DataFrame, weights: dict | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page's main blocks."""
    if weights is None:
        weights = fitted(sampled(pages))
    main = F.filter("blocks", lambda b: b["score"] >= threshold)
    text = F.array_join(main["text"], " ")
    return label_blocks(pages, weights).select("page_id", "url", text.alias("text")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
