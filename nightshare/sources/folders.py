"""Folders of the shared store, by pyarrow's file systems (file, hdfs, s3, gs, abfs)."""

from __future__ import annotations

from pyarrow import fs


def names(path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    system, place = fs.FileSystem.from_uri(path)
    found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
    return sorted(f.base_name for f in found)


def drop(path: str) -> None:
    """Remove a folder that no commit names any more; one that is gone already is fine."""
    system, place = fs.FileSystem.from_uri(path)
    if system.get_file_info(place).type == fs.FileType.Directory:
        system.delete_dir(place)


def move(old: str, new: str) -> None:
    """Put a folder in the place of another, which goes once the new one is there."""
    system, place = fs.FileSystem.from_uri(old)
    target = fs.FileSystem.from_uri(new)[1]
    head, _, name = target.rpartition("/")
    aside = f"{head}/.old-{name}"  # readers skip names that begin with a dot, also those with an equals sign
    system.create_dir(head, recursive=True)
    if system.get_file_info(aside).type == fs.FileType.Directory:
        system.delete_dir(aside)
    if system.get_file_info(target).type == fs.FileType.Directory:
        system.move(target, aside)
    system.move(place, target)
    if system.get_file_info(aside).type == fs.FileType.Directory:
        system.delete_dir(aside)
