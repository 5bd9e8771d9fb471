"""Left joins on a shared key, with one naming rule for repeated column names."""

from functools import reduce

from pyspark.sql import DataFrame


def collision_names(column_lists) -> list[dict]:
    """Output names for columns of frames that are joined one after the other.

    A name that meets its twin becomes ``name_x`` on the left and ``name_y`` on the right; a third
    copy finds no twin any more and keeps its name. Returns one mapping per frame.
    """
    mappings: list[dict] = []
    owner: dict = {}
    for i, columns in enumerate(column_lists):
        mappings.append({})
        taken = {}
        for c in columns:
            if c in owner:
                j, original = owner.pop(c)
                mappings[j][original] = f"{c}_x"
                taken[f"{c}_x"] = (j, original)
                mappings[i][c] = f"{c}_y"
            else:
                mappings[i][c] = c
            taken[mappings[i][c]] = (i, c)
        owner.update(taken)
    return mappings


def join_features(spine: DataFrame, parts, key="id") -> DataFrame:
    """Left-join feature frames (one row per key) to the spine.

    Columns are renamed before the join, because Spark would keep both copies under
    one name. All joins share the key: the spine is shuffled once, and frames that come
    from ``groupBy(key)`` are already partitioned by it.
    """
    mappings = collision_names([[c for c in p.columns if c != key] for p in parts])
    renamed = [p.withColumnsRenamed({a: b for a, b in m.items() if a != b})
               for p, m in zip(parts, mappings)]
    return reduce(lambda left, right: left.join(right, key, "left"), renamed, spine)


def attach_aggregate(detail: DataFrame, key, *aggregates) -> DataFrame:
    """Aggregate per key and left-join the result back to the detail rows.

    The detail rows are the left side, which adaptive execution may split when a
    key is hot; a window over the key could not be split.
    """
    return detail.join(detail.groupBy(key).agg(*aggregates), key, "left")
