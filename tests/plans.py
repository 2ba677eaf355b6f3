"""Looking at physical plans."""

import re


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def inputs_of_single_partitions(df):
    """For each exchange into one partition, the plan text below it."""
    lines = physical(df).splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            depth = re.search(r"[A-Z]", line).start()
            below = []
            for text in lines[i + 1 :]:
                match = re.search(r"[A-Z*]", text)
                if match and match.start() <= depth:
                    break
                below.append(text)
            found.append("\n".join(below))
    return found
