"""Near duplicates by five-word Jaccard (``jaccard.keep_one``) against the exact similarity of every pair.

The pipeline's near-dedup stage is the SimHash operator now; it is tested against brute force in ``test_pipeline``.
"""

import random

from llm.helpers import docs, syllables
from postloom.llm import jaccard


def plain_sets(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split(" ")
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_kept(rows):
    """The smallest id of each component."""
    sets, label = [plain_sets(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), x in zip(rows, label):
        least[x] = min(d, least.get(x, d))
    return sorted(least.values())


def copies(rng, n, changes):
    """Chains of copies, each made from an earlier text of its chain."""
    chains = [[syllables(rng, rng.randint(150, 400)).split()] for _ in range(8)]
    for _ in range(n):
        chain = rng.choice(chains)
        words = list(rng.choice(chain))
        for _ in range(rng.choice(changes)):
            words[rng.randrange(len(words))] = syllables(rng, 1)
        chain.append(words)
    texts = [" ".join(w) for c in chains for w in c]
    rng.shuffle(texts)
    return list(enumerate(texts))


def stage(spark, rows):
    return jaccard.keep_one(docs(spark, rows))


def test_pairs_over_four_fifths_are_linked(spark):
    rows = copies(random.Random(4), 160, [1, 3, 5, 7, 9, 12])
    assert sorted(r.doc_id for r in stage(spark, rows).collect()) == plain_kept(rows)


def test_a_dense_group_and_its_fringe(spark):
    rng = random.Random(8)
    base = syllables(rng, 300).split()
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.sample(range(300), rng.choice([1, 2, 3, 4, 6, 9])):
            words[at] = syllables(rng, 1)
        rows.append((i, " ".join(words)))
    assert sorted(r.doc_id for r in stage(spark, rows).collect()) == plain_kept(rows)


def test_edges(spark):
    a = syllables(random.Random(2), 100)
    rows = [(3, a), (5, a + " more"), (None, a), (None, "no id"), (None, "No  ID"), (7, None), (8, ""), (9, "x"), (9, a)]
    made = stage(spark, rows)
    got = [(r.doc_id, (r.text or "").lower().split()) for r in made.collect()]
    assert sorted(i for i, _ in got if i is not None) == [3, 7]
    assert [t for i, t in got if i is None] == [["no", "id"]]
    assert made.columns == docs(spark, []).columns and stage(spark, []).count() == 0
