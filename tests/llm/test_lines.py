import random

import pytest

from weftgraph.llm.lines import drop_repeated_lines


def brute(texts, least):
    """Delete every line of a run of ``least`` words or more that stands earlier as well. Texts in reading order."""
    full = [[(n, line.strip()) for n, line in enumerate(t.split("\n")) if line.split()] for t in texts]
    first, gone = {}, [set() for _ in texts]
    for d, lines in enumerate(full):
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(line for _, line in lines[a:b])
                if sum(len(line.split()) for line in run) >= least and first.setdefault(run, (d, a)) != (d, a):
                    gone[d].update(range(a, b))
    kept = []
    for d, text in enumerate(texts):
        ends = [n for n, _ in full[d][1:]] + [len(text.split("\n"))]
        cut = {n for i in gone[d] for n in range(full[d][i][0], ends[i])}
        kept.append("\n".join(line for n, line in enumerate(text.split("\n")) if n not in cut))
    return kept


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(awkward, seed):
    rng = random.Random(seed)
    lines = ["a b c", "d e", "f", "g h i j", "", "  d e ", "k l m n o p q", "r"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14))), "en", "s") for i in range(30)]
    docs += [(40, "\n\n" + docs[3][1] + "\n\n", "en", "s"), (41, docs[3][1], "en", "s"), (42, "", "en", "s"), (43, "f\n" * 60, "en", "s")]
    found = drop_repeated_lines(awkward(docs), min_words=8, deleted="gone")
    assert found.columns == [*awkward(docs).columns, "gone"]
    got = [r.text for r in sorted(found.collect(), key=lambda r: r.doc_id)]
    assert got == brute([d[1] for d in docs], 8)


def test_nulls_and_repeated_rows(awkward):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"x\n{long}", "en", "s"), (2, f"{long}\ny", "en", "s"), (2, f"{long}\ny", "en", "s"), (None, long, None, None), (3, None, "en", "s")]
    found = sorted(((r.doc_id, r.text) for r in drop_repeated_lines(awkward(rows)).collect()), key=str)
    assert found == sorted([(1, f"x\n{long}"), (2, "y"), (2, "y"), (None, ""), (3, None)], key=str)
    assert drop_repeated_lines(awkward([])).count() == 0
    huge = "\n".join(f"{i} {long}" for i in range(3000))
    kept = {r.doc_id: r.text for r in drop_repeated_lines(awkward([(1, huge, "en", "s"), (2, huge + "\nend", "en", "s")])).collect()}
    assert kept == {1: huge, 2: "end"}
