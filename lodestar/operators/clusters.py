"""Order-dependent grouping within one document: containment merges and average-linkage clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def merge_by_containment(names: pd.DataFrame, least: int = 3) -> pd.DataFrame:
    """Mentions (seq, name, key, pages) of one document: each joins the first group whose key equals, contains or is inside its own."""
    groups: list[dict] = []
    for row in names.sort_values("seq").itertuples():
        if not row.key:
            continue
        for group in groups:
            other = group["key"]
            if row.key == other or (min(len(row.key), len(other)) >= least and (row.key in other or other in row.key)):
                group["pages"] += [p for p in row.pages if p not in group["pages"]]
                group["members"].append(row.name)
                break
        else:
            groups.append({"seq": row.seq, "name": row.name, "key": row.key, "pages": list(dict.fromkeys(row.pages)), "members": [row.name]})
    return pd.DataFrame(groups, columns=["seq", "name", "key", "pages", "members"])


def containment_groups(mentions: DataFrame) -> DataFrame:
    """mentions: doc, seq, name, key, pages. The rule depends on order, so each document is one pandas group."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = merge_by_containment(group)
        out.insert(0, "doc", group["doc"].iloc[0])
        return out

    kind = mentions.schema["doc"].dataType.simpleString()
    return mentions.groupBy("doc").applyInPandas(run, f"doc {kind}, seq long, name string, key string, pages array<string>, members array<string>")


def average_linkage(vectors: np.ndarray, threshold: float) -> list[int]:
    """Cluster numbers: the two clusters of the smallest mean cosine distance join until it passes the threshold."""
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    distance = 1 - unit @ unit.T
    clusters = [[i] for i in range(len(vectors))]
    while len(clusters) > 1:
        best = min(((distance[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j))
        if best[0] > threshold:
            break
        clusters[best[1]] += clusters.pop(best[2])
    out = [0] * len(vectors)
    for number, members in enumerate(clusters):
        for i in members:
            out[i] = number
    return out


def semantic_groups(names: DataFrame, threshold: float = 0.3) -> DataFrame:
    """names: doc, name, n_pages, vector. (doc, name, representative): clusters by meaning; the name on most pages stands for its cluster."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("name")
        number = average_linkage(np.stack(group["vector"].to_list()), threshold)
        group = group.assign(cluster=number)
        heads = group.sort_values(["n_pages", "name"], ascending=[False, True]).groupby("cluster")["name"].first()
        return pd.DataFrame({"doc": group["doc"], "name": group["name"], "representative": group["cluster"].map(heads)})

    kind = names.schema["doc"].dataType.simpleString()
    return names.groupBy("doc").applyInPandas(run, f"doc {kind}, name string, representative string")
