"""URL filter: allow and block rules in a trie over reversed host labels and path segments.

The trie is built once on the driver from the rules (its size is that of the rule list, which is a
parameter, not data; ``MAX_RULES`` bounds it) and goes to the workers with the function.

Results by case: a null URL or one without ``://`` has empty host and path, fits no rule and gets
the default verdict; an empty host fits no rule; repeated rows are judged alike; extra columns stay,
and columns named like a result column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: What may be broadcast: rules are kept by hand or as a list of this size at most.
MAX_RULES = 1_000_000
ALLOW, BLOCK = "allow", "block"
RESULT = {"host": pa.string(), "path": pa.string(), "rule": pa.string(), "verdict": pa.string()}
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class Trie:
    """Nodes are dicts: host labels from the last to the first, then whole path segments.

    A rule's last path segment may be the beginning of a URL's segment, so it is kept apart as a
    prefix of its node. The longest rule is the one with most host labels, then the longest path.
    """

    def __init__(self, rules: list[tuple[str, str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"verdict of a rule: {verdict!r}")
            node = self.root
            for label in reversed(host.translate(_LOWER).split(".")):
                node = node.setdefault("h", {}).setdefault(label, {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault("p", {}).setdefault(segment, {})
            ends = node.setdefault("e", {})
            if ends.setdefault(last, (verdict, host + path))[0] != verdict:
                raise ValueError(f"two verdicts for {host}{path}")
            node["l"] = sorted({len(x) for x in ends}, reverse=True)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest fitting rule."""
        if not host:
            return None
        nodes, node = [], self.root
        for label in reversed(host.split(".")):
            if (node := node.get("h", {}).get(label)) is None:
                break
            nodes.append(node)
        segments = path.split("/")
        for node in reversed(nodes):  # most labels first
            best = None
            for k, segment in enumerate(segments):
                for n in node.get("l", ()):
                    if n <= len(segment) and (hit := node["e"].get(segment[:n])):
                        best = hit
                        break
                if k == len(segments) - 1 or (node := node.get("p", {}).get(segment)) is None:
                    break
            if best:
                return best
        return None


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = len(rest)
    for c in "/?#":
        if 0 <= (i := rest.find(c)) < end:
            end = i
    host, path = rest[:end].translate(_LOWER), rest[end:]
    for c in "?#":
        path = path.partition(c)[0]
    return host, path


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], *, url: str = "url", default: str = ALLOW) -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``."""
    trie = Trie(rules)
    kept = pages.select(*[f"`{c}`" for c in pages.columns if c not in RESULT or c == url])
    names = [c for c in kept.columns if c not in RESULT]
    at, rest = kept.columns.index(url), [kept.columns.index(c) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for u in b.column(at).to_pylist():
                host, path = split_url(u)
                verdict, rule = trie.find(host, path) or (default, None)
                rows.append((host, path, rule, verdict))
            own = [b.column(c) for c in rest]
            new = [pa.array(x, pa.string()) for x in (zip(*rows, strict=True) if rows else ([],) * 4)]
            yield pa.RecordBatch.from_arrays(own + new, names=[*names, *RESULT])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name in names]
    return kept.mapInArrow(run, ", ".join(fields + [f"{c} string" for c in RESULT]))
