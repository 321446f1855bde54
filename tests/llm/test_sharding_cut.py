"""Sharding where linked rows outnumber the unlinked ones."""

from collections import Counter, defaultdict

from quotelake.llm import sharding
from tests.conftest import rows


def test_linked_rows_make_room(spark):
    large = [(i, "large") for i in range(700)]
    small = [(1000 + i, f"copy {i // 10}") for i in range(1100)]
    data = large + small + [(5000 + i, f"text {i}") for i in range(200)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    found = rows(sharding.balanced_shards(docs, 10))
    sizes = Counter(r["shard"] for r in found)
    assert sum(sizes.values()) == 2000 and set(sizes.values()) == {200}
    homes = defaultdict(Counter)
    for r in found:
        if r["doc_id"] < 5000:
            homes[r["text_crc32"]][r["shard"]] += 1
    links = sum(c * (c - 1) // 2 for h in homes.values() for c in [sum(h.values())])
    kept = sum(c * (c - 1) // 2 for h in homes.values() for c in h.values())
    whole = sum(len(h) == 1 for h in homes.values())
    top = sum(sorted(max(homes.values(), key=lambda h: sum(h.values())).values())[-4:])
    print("cut", links - kept, "of", links, "whole groups", whole, "of 110; large group's four shards hold", top)
    assert top >= 690 and whole >= 95
