import hashlib

import corpus_pipeline as P
from tests.llm.helpers import docs, odd_columns
from tests.llm.test_byte_bpe import B
from tests.llm.test_decontam import brute as brute_items
from tests.llm.test_exact_dedup import brute as brute_exact
from tests.llm.test_simhash import brute as brute_simhash
from tidemart.llm import toxicity

SF = "/root/testdata/sf0.001"


def brute(spark, rows, chain):
    """The pipeline by plain loops over (doc_id, text)."""
    p = chain.probabilities([t or "" for _, t in rows])[:, -1]
    rows = [r for r, x in zip(rows, p, strict=True) if x < toxicity.THRESHOLD]
    best = {sha: keep for _, keep, _, _, sha in brute_exact(rows)}

    def sha(t):
        return hashlib.sha256("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode()).hexdigest()
    rows = [*dict.fromkeys((i, t) for i, t in rows if best[sha(t)] == i)]
    component = {(i, f): c for i, f, c in brute_simhash(rows)}
    kept = {(i, f) for (i, f), c in component.items() if i == c}
    from tests.llm.test_simhash import brute_fp
    rows = [(i, t) for i, t in rows if (i, brute_fp(t)) in kept]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {i for i, *_ in brute_items(rows, items)}
    bpe = B.ByteBPE(*B.vocabulary())
    out = []
    for i, t in rows:
        if i not in bad:
            ids = bpe.encode(t or "")
            out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                        hashlib.sha256((t or "").encode()).hexdigest(), ids))
    return sorted(out, key=repr)


def test_pipeline_matches_brute_force(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    chain = toxicity.fit(d, spark.read.parquet(f"{SF}/labels.parquet"))
    got = sorted((tuple(r) for r in P.run(spark, SF).collect()), key=repr)
    want = brute(spark, rows, chain)
    assert got == want
    assert 0 < len(got) < len(rows)


def test_stages_handle_odd_rows(spark):
    rows = [(1, "one two three four five six"), (2, "ONE two three four five six"), (3, None), (4, ""), (None, "no id here"),
            (5, "x " * 100_000), (6, "seven eight nine ten"), (6, "seven eight nine ten"), (None, None)]
    for make in (lambda: docs(spark, rows), lambda: odd_columns(docs(spark, rows)), lambda: docs(spark, [])):
        d = make()
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, d, SF)
            assert out.columns == d.columns, name
            d = P.stored(out, "t-stage")
        last = P.STAGES[-1][1](spark, d, SF)
        assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(last.columns)
        ids = sorted(r.doc_id for r in last.collect() if r.doc_id is not None)
        assert ids == ([2, 4, 5, 6] if d.count() else [])


def test_stage_names_and_shape():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]
    assert P.ORACLE_SQL is None
