"""A folder tree entered by handles only, one component at a time, never through a link.

A path that is checked and then used can become a link in between; a handle can't. Every component
below the root is opened relative to the handle of the one above with `O_NOFOLLOW`, so whatever is
written, deleted or changed lies inside the root at that moment.
"""

from __future__ import annotations

import errno
import os
import shutil
import stat
from collections.abc import Sequence
from contextlib import suppress

FOLDER = os.O_RDONLY | os.O_DIRECTORY | os.O_NOFOLLOW | os.O_CLOEXEC
#: What opening a link as a folder gives, and what a component that isn't there any more gives.
NO_FOLDER = (errno.ELOOP, errno.ENOTDIR, errno.ENOENT)


def components(group: str, rel_path: str) -> list[str]:
    """Group and path as components, none of which can leave the folder above."""
    parts = [group, *(rel_path.split("/") if rel_path else [])]
    if any(p in ("", ".", "..") or "/" in p or "\0" in p for p in parts):
        raise ValueError(f"not a path inside a group: {group!r}, {rel_path!r}")
    return parts


class Confined:
    """Handles of the root and of the folders on the way to the last place; neighbours in order share them."""

    def __init__(self, root: str):
        self.root = os.open(root, FOLDER)
        self.way: list[tuple[str, int]] = []

    def __enter__(self) -> Confined:
        return self

    def __exit__(self, *_) -> None:
        self._back(0)
        os.close(self.root)

    def _back(self, depth: int) -> None:
        while len(self.way) > depth:
            os.close(self.way.pop()[1])

    def _into(self, above: int, name: str, make: bool) -> int:
        try:
            return os.open(name, FOLDER, dir_fd=above)
        except OSError as e:
            if not make or e.errno not in NO_FOLDER:
                raise
        with suppress(FileNotFoundError):
            if stat.S_ISLNK(os.stat(name, dir_fd=above, follow_symlinks=False).st_mode):
                os.unlink(name, dir_fd=above)
        with suppress(FileExistsError):  # another task may have made it
            os.mkdir(name, dir_fd=above)
        return os.open(name, FOLDER, dir_fd=above)

    def enter(self, parts: Sequence[str], make: bool = False) -> int:
        """Handle of a folder, valid until the next call. With `make`, missing ones are made and links replaced."""
        same = 0
        while same < min(len(parts), len(self.way)) and parts[same] == self.way[same][0]:
            same += 1
        self._back(same)
        for name in parts[same:]:
            self.way.append((name, self._into(self.way[-1][1] if self.way else self.root, name, make)))
        return self.way[-1][1] if self.way else self.root

    def make_folder(self, parts: Sequence[str]) -> None:
        self.enter(parts, make=True)

    def place(self, parts: Sequence[str], name: str, beside: int) -> None:
        """Rename `name` in the folder `beside` to this path; replaces a file or a link, never writes through one."""
        os.replace(name, parts[-1], src_dir_fd=beside, dst_dir_fd=self.enter(parts[:-1], make=True))

    def holds(self, parts: Sequence[str], source: str) -> bool:
        """Whether the file at this path is what `copy_into` would put there, by all its bytes; it then gets mode and times of `source`.

        Files with a second name (a hard link), of another owner, or with extended attributes on either side don't count.
        """
        above = self.enter(parts[:-1], make=True)
        try:
            found = os.stat(parts[-1], dir_fd=above, follow_symlinks=False)
            if not stat.S_ISREG(found.st_mode) or found.st_nlink != 1 or found.st_uid != os.geteuid() or found.st_size != os.stat(source).st_size:
                return False
            handle = os.open(parts[-1], os.O_RDONLY | os.O_NOFOLLOW | os.O_NONBLOCK | os.O_CLOEXEC, dir_fd=above)
        except OSError:  # there is none, or none that can be read: the copy says what is wrong
            return False
        with os.fdopen(handle, "rb") as held, open(source, "rb") as data:
            now, at_once = os.fstat(handle), min(found.st_size + 1, 1 << 20)
            if (now.st_dev, now.st_ino) != (found.st_dev, found.st_ino):
                return False
            while part := data.read(at_once):
                if held.read(at_once) != part:
                    return False
            if held.read(1):
                return False
            with suppress(OSError):  # the file system may have none
                if os.listxattr(handle) or os.listxattr(data.fileno()):
                    return False
            like = os.fstat(data.fileno())
            os.fchmod(handle, stat.S_IMODE(like.st_mode))
            os.utime(handle, ns=(like.st_atime_ns, like.st_mtime_ns))
        return True

    def delete(self, parts: Sequence[str]) -> bool:
        """Remove a file, a link or an empty folder; False if the folder isn't empty. What is gone, or lies behind a link, is no error."""
        try:
            above = self.enter(parts[:-1])
            if stat.S_ISDIR(os.stat(parts[-1], dir_fd=above, follow_symlinks=False).st_mode):
                os.rmdir(parts[-1], dir_fd=above)
            else:
                os.unlink(parts[-1], dir_fd=above)
        except OSError as e:
            if e.errno == errno.ENOTEMPTY:
                return False
            if e.errno not in NO_FOLDER:
                raise
        return True

    def like(self, parts: Sequence[str], source: os.stat_result) -> None:
        """Mode and times of a folder; one that is gone or has become a link is left."""
        try:
            handle = self.enter(parts)
        except OSError as e:
            if e.errno not in NO_FOLDER:
                raise
            return
        os.utime(handle, ns=(source.st_atime_ns, source.st_mtime_ns))
        os.fchmod(handle, stat.S_IMODE(source.st_mode))


def copy_into(source: str, folder: int, name: str) -> int:
    """A new file `name` in the folder with the content, mode, times and extended attributes of `source`; its size."""
    with open(source, "rb") as data, os.fdopen(os.open(name, os.O_WRONLY | os.O_CREAT | os.O_EXCL | os.O_NOFOLLOW | os.O_CLOEXEC, 0o600, dir_fd=folder), "wb") as out:
        shutil.copyfileobj(data, out, min(os.fstat(data.fileno()).st_size + 1, 1 << 20))
        out.flush()
        found = os.fstat(data.fileno())
        with suppress(OSError):  # the file system may have none
            for attribute in os.listxattr(data.fileno()):
                os.setxattr(out.fileno(), attribute, os.getxattr(data.fileno(), attribute))
        os.fchmod(out.fileno(), stat.S_IMODE(found.st_mode))
        os.utime(out.fileno(), ns=(found.st_atime_ns, found.st_mtime_ns))
        return out.tell()


def write_into(content: bytes, mode: int | None, mtime_ns: int | None, folder: int, name: str) -> int:
    """As `copy_into`, of given bytes."""
    with os.fdopen(os.open(name, os.O_WRONLY | os.O_CREAT | os.O_EXCL | os.O_NOFOLLOW | os.O_CLOEXEC, 0o600, dir_fd=folder), "wb") as out:
        out.write(content)
        out.flush()
        os.fchmod(out.fileno(), 0o644 if mode is None else mode)
        if mtime_ns is not None:
            os.utime(out.fileno(), ns=(mtime_ns, mtime_ns))
    return len(content)
