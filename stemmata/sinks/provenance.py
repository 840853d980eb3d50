"""Where a dataset comes from and under which terms. Two claims that are kept apart: that the bytes are those of a
commit, and that somebody has looked up the terms of that commit. Neither is made without evidence."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

VERIFIED, UNVERIFIED = "verified", "unverified"


@dataclass(frozen=True)
class Terms:
    """Terms of one commit of one repository, as looked up."""

    licence: str
    licence_url: str
    licence_source: str
    scope: str
    attribution: str
    citation: str


Known = Mapping[tuple[str, str], Terms]
# The published sources, and the terms of the commit for which they were looked up.
REPOSITORY = "https://github.com/OnlineCriticalPseudepigrapha/Online-Critical-Pseudepigrapha"
COMMIT = "c939dcbacad78c5d18d2c4282cad23c47e19ac07"
LOOKED_UP: Known = {
    (REPOSITORY, COMMIT): Terms(
        "CC-BY-4.0", "https://creativecommons.org/licenses/by/4.0/", f"{REPOSITORY}/blob/{COMMIT}/LICENSE.CC-BY-4.0", "OCP text editions and TEI XML files under static/docs/",
        "Online Critical Pseudepigrapha (OCP) and the individual editor named in each document's header/public metadata.",
        "Ian W. Scott and Ken M. Penner, eds. The Online Critical Pseudepigrapha. Atlanta: Society of Biblical Literature / Online: pseudepigrapha.org.",
    )
}


def describe(repository: str, commit: str, known: Known, *, detected: str | None = None, clean: bool = False) -> dict[str, str]:
    """What may be said of a source: its identity if the checkout was found at the commit and unchanged, then its terms if known."""
    doubts = ([] if detected and detected == commit else [f"recorded commit {commit!r}, found {detected!r}"]) + ([] if clean else ["the source folder has changes"])
    out = {"repository": repository, "commit": commit, "identity_status": UNVERIFIED if doubts else VERIFIED, "licence_status": UNVERIFIED}
    if doubts:
        return out | {"identity_diagnostic": "; ".join(doubts)}
    if (terms := known.get((repository, commit))) is None:
        return out | {"licence_diagnostic": f"no terms are known for {repository!r} at {commit!r}"}
    return out | {"licence_status": VERIFIED} | asdict(terms)


def consistent(recorded: Mapping[str, str], known: Known) -> bool:
    """Whether a record claims neither more nor less than its identity allows."""
    status = recorded.get("identity_status")
    if status not in (VERIFIED, UNVERIFIED):
        return False
    commit = recorded.get("commit", "")
    made = describe(recorded.get("repository", ""), commit, known, detected=commit if status == VERIFIED else None, clean=status == VERIFIED)
    drop = {"identity_diagnostic"}
    return {k: v for k, v in recorded.items() if k not in drop} == {k: v for k, v in made.items() if k not in drop} and (status == VERIFIED) != bool(recorded.get("identity_diagnostic"))
