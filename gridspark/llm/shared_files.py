"""Binary files in a shared folder, opened by URI from tasks."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; ``file:/x`` and bare paths are local."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def replaced(uri: str) -> Iterator:
    """An output stream whose file appears under ``uri`` only when complete.

    A task that is run again, or twice at once, writes the same bytes and the
    last rename wins, so readers never see part of a file.
    """
    system, path = locate(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    stream = system.open_output_stream(part)
    try:
        yield stream
        stream.close()
        system.move(part, path)
    except BaseException:
        with contextlib.suppress(OSError):
            stream.close()
            system.delete_file(part)
        raise


@contextlib.contextmanager
def opened(uri: str) -> Iterator:
    """A random-access input file."""
    system, path = locate(uri)
    with system.open_input_file(path) as stream:
        yield stream
