"""The ring law row by row, against the planned runs."""

import collections
import random

from civicspark.llm import ring


def one_by_one(keys, shards, vnodes):
    """Every row applies to its home, round after round, and is taken while the shard has room."""
    nodes = ring.virtual_nodes(shards, vnodes)
    room = ring.capacities(len(keys), shards)
    homes = collections.defaultdict(list)
    for i, k in enumerate(keys):
        at = ring.ring_position("" if k is None else str(k))
        home = next((n for n, (p, _) in enumerate(nodes) if p >= at), 0)
        # the arc that wraps past the end starts there
        homes[home].append((at <= nodes[-1][0] if home == 0 else 0, at, i))
    queue = [(arc, i) for arc in sorted(homes) for _, _, i in sorted(homes[arc])]
    place = {}
    now = [(arc, arc, i) for arc, i in queue]
    while now:
        over = []
        for arc, node, i in now:
            s = nodes[node][1]
            if room[s]:
                room[s] -= 1
                place[i] = s
            else:
                over.append((arc, node, i))
        now = []
        for arc, node, i in over:
            while not room[nodes[node][1]]:
                node = (node + 1) % len(nodes)
            now.append((arc, node, i))
    return place


def test_every_row_goes_where_the_law_sends_it(spark):
    rng = random.Random(6)
    keys = rng.sample(range(10 ** 6), 700)
    df = spark.createDataFrame([(k, f"t{k}") for k in keys], "doc_id long, text string")
    for shards, vnodes in ((5, 3), (24, 16), (1, 2)):
        place = one_by_one(keys, shards, vnodes)
        got = {r.doc_id: r.shard for r in ring.shard_documents(df, shards, vnodes).collect()}
        want = {k: place[i] for i, k in enumerate(keys)}
        assert got == want
