"""A comparison as an HTML page: the same bytes for the same model, everything escaped."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import parse_qsl

from ..functions.text import comparison_address, escaped

#: How the absences of a text are named to readers.
ABSENT = {"omission": "[omission]", "unattested": "[not attested]", "not_present": "passage not in this version", "metadata_only": "no text"}


def _segments(segments: list[dict]) -> str:
    cells = []
    for s in segments:
        status = s.get("status", "reading")
        shown = escaped(s["text"]) if s.get("text") else f"<em>{escaped(ABSENT.get(status, ABSENT['omission']))}</em>"
        cells.append(f'<span class="{escaped(status)}" data-unit="{escaped(s["unit"])}">{shown}</span>')
    return " ".join(cells)


def render(model: dict, neighbours: dict | None = None) -> str:
    work, (chapter, verse) = model["work"], model["reference"]
    chosen = [v["version_id"] for v in model["versions"]]
    parts = ["<!DOCTYPE html>", f"<title>{escaped(work)} {escaped(chapter)}:{escaped(verse)}</title>", f"<h1>{escaped(work)} {escaped(chapter)}:{escaped(verse)}</h1>"]
    for name in ("previous", "next"):
        if neighbours and neighbours.get(name):
            parts.append(f'<a rel="{name}" href="{escaped(comparison_address(work, *neighbours[name], versions=chosen))}">{name}</a>')
    parts.append("<ul>" + "".join(f"<li>{escaped(c['title'])} ({escaped(c['status'])}){' *' if c['selected'] else ''}</li>" for c in model["version_choices"]) + "</ul>")
    for v in model["versions"]:
        parts.append(f'<section id="{escaped(v["version_id"])}"><h2>{escaped(v["title"])}</h2>')
        if v["status"] != "available":
            parts.append(f"<p><em>{escaped(ABSENT[v['status']])}</em></p>")
        else:
            parts.append(f"<p>{_segments(v['primary_segments'])}</p>")
            parts += [f"<h3>{escaped(w['witness'])}</h3><p>{_segments(w['segments'])}</p>" for w in v["witnesses"]]
            parts += [f"<h3>{escaped(t['title'])} ({escaped(t['language'])})</h3><p>{_segments(t['segments'])}</p>" for t in v["translations"]]
        parts.append("</section>")
    parts += [f"<p>{escaped(m['title'])}: {ABSENT['metadata_only']}</p>" for m in model["metadata_only_versions"]]
    return "\n".join(parts) + "\n"


def landing(works: list[tuple[str, str]]) -> str:
    return "<!DOCTYPE html>\n<title>Works</title>\n<ul>\n" + "".join(f"<li>{escaped(label)} <code>{escaped(work)}</code></li>\n" for work, label in works) + "</ul>\n"


def route(query: str, works: Callable[[], list[tuple[str, str]]], compare: Callable[..., dict], around: Callable[..., dict]) -> tuple[int, str]:
    """(status, page) of a request: the list of works without a place, the comparison, or an error page.

    A version or witness parameter that is present and empty selects nothing; one that is absent leaves the defaults.
    """
    given = parse_qsl(query, keep_blank_values=True)
    one = {k: v.strip() for k, v in given if k in ("work", "chapter", "verse")}
    if not all(one.get(k) for k in ("work", "chapter", "verse")):
        return 200, landing(works())
    some = lambda key: [v for k, v in given if k == key and v] if any(k == key for k, _ in given) else None
    versions = some("version")
    witnesses = {k.removeprefix("witness."): some(k) for k, _ in given if k.startswith("witness.")} or None
    try:
        model = compare(one["work"], one["chapter"], one["verse"], versions=versions, witnesses=witnesses)
        return 200, render(model, around(one["work"], one["chapter"], one["verse"], versions or ()))
    except (KeyError, ValueError) as e:
        return 400, f"<!DOCTYPE html>\n<title>Error</title>\n<p>{escaped(e)}</p>\n"
