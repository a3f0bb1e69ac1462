"""What a query has read, from its executed plan."""

from __future__ import annotations


def nodes(df) -> list:
    """All nodes of the plan, after the query has run."""
    df = df.select("*")  # a plan reports its files on the first run only
    df.collect()
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        found.append(node)
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            waiting.append(node.plan())
        else:
            children = node.children()
            waiting += [children.apply(i) for i in range(children.size())]
    return found


def metric(node, name: str) -> int:
    return node.metrics().apply(name).value()


def files_read(df, column: str) -> int:
    """Files opened by the scans that read a column."""
    scans = [n for n in nodes(df) if n.nodeName().startswith("Scan parquet") and f"{column}#" in n.toString()]
    assert scans
    return sum(metric(n, "numFiles") for n in scans)


def rows_shuffled(df) -> int:
    return sum(metric(n, "shuffleRecordsWritten") for n in nodes(df) if n.nodeName() == "Exchange")
