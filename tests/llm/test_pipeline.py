"""run() against a brute-force pipeline; the classifier's decisions are taken from its query, which has tests of its own."""

import corpus_pipeline
from parcelion.llm.mixing import BLOCK_ROWS
from parcelion.llm.queries import OTHER_WEIGHT, QUERIES, SOURCE_WEIGHTS

from .plain import clean_lines, components, earliest_deadline, hits


def test_pipeline_equals_brute_force(spark, sf):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    kept = {r.doc_id for r in QUERIES["op10_quality"](spark, sf).collect() if r.kept}
    texts = clean_lines({key: row.text for key, row in rows.items() if key in kept})
    texts = {key: texts[key] for key, smallest in components(texts).items() if key == smallest}
    texts = {key: text for key, text in texts.items() if not hits(text, items)[1]}

    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert {key: r.text for key, r in found.items()} == texts
    assert all(found[key][c] == rows[key][c] for key in found for c in ("lang", "source", "n_chars"))
    names = sorted(SOURCE_WEIGHTS)
    group = lambda source: names.index(source) if source in SOURCE_WEIGHTS else len(names)
    sizes = [sum(group(r.source) == g for r in found.values()) for g in range(len(names) + 1)]
    slots = earliest_deadline([-(-n // BLOCK_ROWS) for n in sizes], [*(SOURCE_WEIGHTS[n] for n in names), OTHER_WEIGHT])
    assert {(group(r.source), r.block): r.slot for r in found.values()} == {pick: slot for slot, pick in enumerate(slots)}
    assert sorted(r.position for r in found.values()) == list(range(len(found)))


def test_stages_are_those_of_the_operators():
    assert len(corpus_pipeline.STAGES) == 5
