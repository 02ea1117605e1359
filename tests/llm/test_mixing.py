import hashlib

import pytest

from plantmetrics.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, mix_epoch int, own string"


def rows_of(sizes):
    out, key = [], 0
    for (lang, source), lengths in sizes.items():
        for n in lengths:
            out.append((key, " ".join(["w"] * n), lang, source, 5, "x"))
            key += 1
    return out


def share_out(budget, capacity, weight):
    """Give by weight, round after round, what children can still take."""
    given = dict.fromkeys(capacity, 0.0)
    open_to = {k for k in capacity if weight[k] > 0}
    while budget > 1e-9 and open_to:
        total = sum(weight[k] for k in open_to)
        if all(given[k] + budget * weight[k] / total <= capacity[k] for k in open_to):
            return {k: given[k] + (budget * weight[k] / total if k in open_to else 0) for k in given}
        step = min((capacity[k] - given[k]) / weight[k] for k in open_to)
        for k in open_to:
            given[k] += step * weight[k]
        budget -= step * total
        open_to = {k for k in open_to if given[k] < capacity[k] - 1e-9}
    return given


def expected(rows, plan):
    tree = {}
    for key, text, lang, source, *_ in rows:
        leaf = tree.setdefault(plan.domains.get(source, "other"), {}).setdefault(lang or "null", {}).setdefault(source or "null", [])
        leaf.append((key, len((text or "").split())))
    size = {d: {a: {s: sum(n for _, n in x) for s, x in b.items()} for a, b in c.items()} for d, c in tree.items()}
    total = sum(s for c in size.values() for b in c.values() for s in b.values())
    room = plan.max_epochs
    by_domain = share_out(total * plan.budget_share, {d: room * sum(sum(b.values()) for b in c.values()) for d, c in size.items()}, {d: plan.domain_weights.get(d, 1.0) for d in size})
    out = []
    for d, c in size.items():
        by_lang = share_out(by_domain[d], {a: room * sum(b.values()) for a, b in c.items()}, {a: plan.lang_weights.get(a, 1.0) for a in c})
        for a, b in c.items():
            by_source = share_out(by_lang[a], {s: room * n for s, n in b.items()}, {s: plan.source_weights.get(s, 1.0) for s in b})
            for s, n in b.items():
                budget = int(by_source[s] + 1e-6)
                whole = budget // n if n else 0
                left = budget - whole * n
                order = sorted(tree[d][a][s], key=lambda x: hashlib.md5(f"{plan.seed}:{whole + 1}:{'null' if x[0] is None else x[0]}".encode()).hexdigest())
                places, at = [], 0
                for key, words in order:
                    at += words
                    places.append((key, whole + (at <= left)))
                out += [(key, e) for key, times in places for e in range(1, times + 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [0.3, 0.9, 2.5, 10.0])
def test_like_the_plain_algorithm(frame, share):
    rows = rows_of({
        ("en", "src0"): [50] * 30, ("en", "src1"): [7] * 5, ("de", "src0"): [3, 4, 5], ("fr", "src6"): [90] * 4, (None, "src7"): [11] * 9, ("en", None): [8, 0, 0, 2],
        ("es", "elsewhere"): [600], ("en", "src15"): [1] * 400,
    })
    plan = M.Mix(budget_share=share, max_epochs=3)
    mixed = M.mix(frame(rows, SCHEMA).drop("mix_epoch"), plan)
    assert sorted(((r.doc_id, r.mix_epoch) for r in mixed.collect()), key=repr) == expected(rows, plan)


def test_a_shortage_goes_to_siblings_first(frame):
    plan = M.Mix(domains={"a": "x", "b": "x", "c": "y"}, domain_weights={}, lang_weights={}, budget_share=1.0, max_epochs=2)
    rows = rows_of({("en", "a"): [10] * 2, ("en", "b"): [10] * 48, ("en", "c"): [10] * 50})
    got = M.mix(frame(rows, SCHEMA).drop("mix_epoch"), plan).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in got} == {"a": 4, "b": 46, "c": 50}


def test_columns_nulls_repeats_and_empty(frame):
    rows = [(None, None, None, None, 1, "k"), (1, "a b", "en", "src0", 1, "k"), (1, "a b", "en", "src0", 1, "k"), (2, "", "en", "src0", 1, "k")]
    mixed = M.mix(frame(rows, SCHEMA).drop("mix_epoch"), M.Mix(budget_share=1.0, max_epochs=1))
    assert mixed.columns == ["doc_id", "text", "lang", "source", "own", "mix_domain", "mix_epoch"]
    assert sum(r.doc_id == 1 for r in mixed.collect()) == 2
    assert M.mix(frame([], SCHEMA).drop("mix_epoch")).count() == 0


def test_added_columns_never_share_a_name(frame):
    docs = frame([(1, "a b", "en", "src0", 5, "x")], SCHEMA).withColumnRenamed("own", "MIX_DOMAIN")
    mixed = M.mix(docs, M.Mix(budget_share=1.0, max_epochs=1))
    assert mixed.columns == [*docs.columns, "mix_domain_", "mix_epoch_"]
    (row,) = mixed.collect()
    assert (row["mix_epoch"], row["MIX_DOMAIN"], row["mix_domain_"], row["mix_epoch_"]) == (5, "x", "web", 1)


@pytest.mark.parametrize("share", [0.2, 0.7, 1.3])
def test_a_third_of_all_rows_without_id(frame, share):
    rows = rows_of({("en", "src0"): [3] * 600, ("de", "src6"): [2] * 50})
    rows = [(None if k % 3 == 0 else k, *r) for k, *r in rows]
    docs = frame(rows, SCHEMA).drop("mix_epoch")
    got = M.mix(docs, M.Mix(budget_share=share, max_epochs=2)).collect()
    named = sorted((r.doc_id, r.mix_epoch) for r in got if r.doc_id is not None)
    assert len(named) == len(set(named))
    for lang, source in (("en", "src0"), ("de", "src6")):
        for epoch in (1, 2):
            taken = sum(r.doc_id is None and r.lang == lang and r.mix_epoch == epoch for r in got)
            assert taken in (0, sum(r[0] is None and r[2] == lang for r in rows))  # Rows of one place go together.
    budgets = {tuple(r[:3]): r for r in M.leaf_budgets(docs.selectExpr(
        "doc_id AS id", "CAST(regexp_count(text, 'w') AS BIGINT) AS n_tokens", "CASE source WHEN 'src0' THEN 'web' ELSE 'news' END AS m_domain",
        "lang AS m_lang", "source AS m_source"), M.Mix(budget_share=share, max_epochs=2)).collect()}
    for (domain, lang, source), leaf in budgets.items():
        assert sum(len(r.text.split()) for r in got if r.source == source) <= leaf["budget"]
