"""Releases: archives whose bytes depend on their contents only, and manifests that bind names to digests."""

from __future__ import annotations

import hashlib
import json
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import git_sha, not_blank, path_component
from ..operators.guards import none_of
from ..sources import archives
from ..sources.dataset import archive_members

#: Fixed value: the earliest time that archives can hold.
EPOCH = (1980, 1, 1, 0, 0, 0)
VERSION = 1


def archive(files: dict[str, str], target: str) -> list[tuple[str, int, str]]:
    """Write files (member name -> path) sorted, with fixed times and modes; returns (name, bytes, sha256)."""
    with zipfile.ZipFile(target, "x", zipfile.ZIP_DEFLATED, compresslevel=9) as out:
        for name in sorted(files):
            info = zipfile.ZipInfo(path_component(name, "member"), EPOCH)
            info.compress_type, info.external_attr, info.create_system = zipfile.ZIP_DEFLATED, 0o100644 << 16, 3
            with open(files[name], "rb") as source, out.open(info, "w", force_zip64=True) as member:
                while part := source.read(1 << 20):
                    member.write(part)
    return archive_members(target)


def identity(records: list[tuple[str, int, str]]) -> dict:
    """Number, size and one digest of a set of members, whatever their order."""
    canonical = json.dumps([{"bytes": n, "name": name, "sha256": sha} for name, n, sha in sorted(records)], separators=(",", ":"), sort_keys=True)
    return {"files": len(records), "bytes": sum(n for _, n, _ in records), "sha256": hashlib.sha256(canonical.encode()).hexdigest()}


def folder_records(folder: str) -> list[tuple[str, int, str]]:
    found = []
    for root, _, names in os.walk(folder):
        for n in names:
            path = os.path.join(root, n)
            if os.path.islink(path):
                raise ValueError(f"{path} is a link")
            digest = hashlib.sha256()
            with open(path, "rb") as f:
                while part := f.read(1 << 20):
                    digest.update(part)
            found.append((os.path.relpath(path, folder), os.path.getsize(path), digest.hexdigest()))
    return sorted(found)


def gate(report: dict) -> None:
    """A report that lets a release go: there are checks, all are exactly true, and none failed."""
    checks = report.get("checks")
    if not isinstance(checks, dict) or not checks or any(ok is not True for ok in checks.values()):
        raise ValueError("not all checks are true")
    if report.get("status") != "passed" or report.get("failed_checks") != []:
        raise ValueError("the report's status and its checks disagree")


def manifest(archive_path: str, report: dict, *, tag: str, commit: str, upstream_commit: str, licence: str) -> dict:
    gate(report)
    members = archive_members(archive_path)
    with open(archive_path, "rb") as f:
        whole = hashlib.file_digest(f, "sha256").hexdigest()
    return {
        "schema_version": VERSION,
        "release": {"tag": path_component(tag, "tag"), "commit": git_sha(commit, "commit")},
        "upstream": {"commit": git_sha(upstream_commit, "upstream commit"), "licence": not_blank(licence, "licence")},
        "assets": {"name": os.path.basename(archive_path), "sha256": whole, "members": [{"name": n, "bytes": b, "sha256": s} for n, b, s in members], "identity": identity(members)},
        "audit": {"checks": len(report["checks"]), "status": report["status"]},
    }


def manifest_bytes(value: dict) -> bytes:
    return (json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode()


def validate(value: dict, archive_path: str, report: dict) -> None:
    """ValueError unless archive and report are those of the manifest."""
    release, upstream = value["release"], value["upstream"]
    again = manifest(archive_path, report, tag=release["tag"], commit=release["commit"], upstream_commit=upstream["commit"], licence=upstream["licence"])
    if again != value:
        raise ValueError("the release differs from its manifest")


def compared(spark: SparkSession, expected: str, found: str, *, without: str = "", folder: str = "") -> DataFrame:
    """(member, kind, expected_sha256, found_sha256) of the members by which one archive differs from another, read by tasks.

    ``folder``: where in the second archive the first one's members stand, as an archive that adds an application has its
    data; what it holds elsewhere is left out. ``without``: a pattern of members of the second that need no partner.
    """
    first, second = archives.read(spark, expected), archives.read(spark, found)
    if folder:
        inside = f"{folder.strip('/')}/"
        second = second.where(F.col("member").startswith(inside) | F.col("problem").isNotNull()).withColumn("member", F.replace("member", F.lit(inside), F.lit("")))
    if without:
        second = second.where(~F.col("member").rlike(without))
    return archives.differences(first, second, by=[])


def same_members(spark: SparkSession, expected: str, found: str, **how: str) -> None:
    """ValueError that names members unless the two archives hold the same."""
    none_of(compared(spark, expected, found, **how), f"{found} differs from {expected}")


def listed(spark: SparkSession, value: dict) -> DataFrame:
    """The members that a manifest lists, as ``archives.read`` gives those of its archive."""
    assets = value["assets"]
    rows = [(assets["name"], m["name"], m["bytes"], None, m["sha256"], None) for m in assets["members"]]
    return spark.createDataFrame(rows, archives.ROWS)


def validate_folder(value: dict, folder: str) -> None:
    """ValueError unless the files of a folder are those that a manifest lists, no more and no fewer, byte by byte."""
    listed_ = {m["name"]: (m["bytes"], m["sha256"]) for m in value["assets"]["members"]}
    found = {name: (n, digest) for name, n, digest in folder_records(folder)}
    if wrong := sorted(k for k in listed_.keys() | found.keys() if listed_.get(k) != found.get(k)):
        raise ValueError(f"{folder} differs from its manifest: {', '.join(wrong[:5])}")


def stage(files: dict[str, str], folder: str, report: dict, **identity_: str) -> dict[str, str]:
    """Archive, report and manifest of a release in a folder that is empty or new."""
    os.makedirs(folder, exist_ok=True)
    if os.listdir(folder):
        raise ValueError(f"{folder} is not empty")
    out = {k: os.path.join(folder, n) for k, n in (("archive", "complete.zip"), ("report", "report.json"), ("manifest", "manifest.json"))}
    archive(files, out["archive"])
    value = manifest(out["archive"], report, **identity_)
    for kind, data in (("report", manifest_bytes(report)), ("manifest", manifest_bytes(value))):
        with open(out[kind], "xb") as f:
            f.write(data)
    validate(value, out["archive"], report)
    return out
