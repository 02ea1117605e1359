import random

import pyarrow as pa
import pytest

from plantmetrics.llm import decontaminate as D

ITEM = " ".join(f"item{k}" for k in range(30))
FILL = " ".join(f"fill{k}" for k in range(40))


def fewest_edits(item, text):
    before = list(range(len(item) + 1))
    best = len(item)
    for word in text:
        now = [0]
        for j, own in enumerate(item, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (own != word)))
        before, best = now, min(best, now[-1])
    return best


@pytest.mark.parametrize("seed", range(6))
def test_like_brute_force(seed):
    random.seed(seed)
    for _ in range(150):
        item = [random.randrange(6) for _ in range(random.randint(1, 80))]
        text = [random.randrange(6) for _ in range(random.randint(0, 90))]
        if random.random() < 0.7:
            near = item[:]
            for _ in range(random.randint(0, max(1, len(item) // 4))):
                at = random.randrange(len(near) + 1)
                near[at:at + random.randint(0, 1)] = [random.randrange(6)] * random.randint(0, 1)
            text[10:10] = near
        spelled = [" ".join(f"w{k}" for k in words) for words in (item, text)]
        matcher = D.Matcher([5], [spelled[0]])
        words, _ = D.plain_words(pa.array([spelled[1]]))
        hits = list(matcher.hits(words))
        want, allowed = fewest_edits(item, text), D.errors_allowed(len(item))
        assert [h[1] for h in hits] == ([want] if want <= allowed else [])


def documents(frame):
    edited = ITEM.replace("item3 ", "").replace("item9", "other").replace("item20", "item20 more").replace("item5", "ITEM5!")
    half = " ".join(ITEM.split()[:15])
    rows = [
        (1, f"{FILL} {ITEM} {FILL}"), (2, f"{FILL}\n{edited.upper()},"), (3, FILL), (4, None), (5, ""), (6, half), (None, ITEM), (1, f"{FILL} {ITEM} {FILL}"),
        (7, f"{FILL} " * 3000 + ITEM), (8, "... --- !!!"),
    ]
    return frame([(k, t, 9) for k, t in rows], "doc_id long, text string, item_id int")


def items(frame):
    return frame([(10, ITEM, 0), (10, ITEM, 0), (11, None, 0), (12, "", 0), (13, "?!", 0), (None, "fill39 item0", 0)], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_matches(frame, block):
    got = D.matches(documents(frame), items(frame), block_bytes=block).collect()
    whole = sorted((r.doc_id, r.edits) for r in got if r.item_id == 10 and r.doc_id)
    assert whole == [(1, 0), (1, 0), (2, 3), (7, 0)]
    assert sum(r.doc_id is None for r in got) == 1 and {r.item_id for r in got} == {10, None}


def test_drop(frame):
    only = items(frame).filter("item_id = 10")
    kept = D.drop_contaminated(documents(frame), only, block_bytes=1)
    assert kept.columns == ["doc_id", "text", "item_id"] and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 8]


def test_empty_sides(frame):
    assert D.matches(documents(frame), items(frame).limit(0)).count() == 0
    assert D.matches(documents(frame).limit(0), items(frame)).count() == 0
    assert D.drop_contaminated(documents(frame), items(frame).limit(0)).count() == 10
