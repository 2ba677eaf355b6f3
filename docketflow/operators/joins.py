"""Joins that only filter."""


def filtering_join(left, right, keys, how):
    """Left rows with (`left_semi`) or without (`left_anti`) a match in `right`.

    Both sides go into the join straight from one shuffle each, the right one with its
    keys alone. Spark can then send a small right side to the left rows, and split the
    left rows of a key that holds very many. Repeats on the right cost reading only: of
    each key the join keeps one row.
    """
    return left.join(right.select(*keys), list(keys), how).select(*left.columns)
