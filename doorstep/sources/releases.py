"""Tables that are shown together: folders behind one pointer.

A release is written aside, below ``<out>/releases``.  What shows it is one new file below
``<out>/current/<layer>``, whose name ascends and which says where each table lies.  Its
appearing is the only step, so a reader finds all tables of the former release or all of
the new one, whenever a job ends, and no file or folder is ever replaced by another.
Readers that looked up a release keep it: the last ``keep`` ones stay.
"""

import json
import uuid

from pyarrow import fs

from .files import delete_folder, opened


class NotPublished(Exception):
    """The layer has no release, or its release no such table."""


class Release:
    """A layer's tables, to be written to ``path(name)`` and shown at the end of the block.

    A block that fails leaves no trace.  ``share`` takes over a table of the release before.
    """

    def __init__(self, out, layer, keep=2):
        self.out, self.layer, self.keep = out.rstrip("/"), layer, keep
        self.folder = f"{self.out}/releases/{layer}-{uuid.uuid4().hex}"
        self.tables = {}

    def path(self, name):
        self.tables[name] = f"{self.folder}/{name}"
        return self.tables[name]

    def share(self, name):
        self.tables[name] = table_path(self.out, self.layer, name)
        return self.tables[name]

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is not None:
            delete_folder(self.folder)
            return
        _point(self.out, self.layer, self.tables)
        _prune(self.out, self.layer, self.keep)


def _pointers(out, layer):
    """(files, folder, names of the pointers, oldest first)."""
    files, folder = opened(f"{out.rstrip('/')}/current/{layer}")
    listed = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return files, folder, sorted(i.base_name for i in listed if not i.base_name.startswith("_"))


def _point(out, layer, tables):
    files, folder, names = _pointers(out, layer)
    files.create_dir(folder, recursive=True)
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    mark = uuid.uuid4().hex
    draft = f"{folder}/_{mark}"
    with files.open_output_stream(draft) as stream:
        stream.write(json.dumps(tables).encode())
    files.move(draft, f"{folder}/{number:012d}-{mark}")


def _read(files, folder, name):
    with files.open_input_stream(f"{folder}/{name}") as stream:
        return json.loads(stream.read())


def released(out, layer):
    """{table: path} of the layer's newest release, {} without one."""
    files, folder, names = _pointers(out, layer)
    return _read(files, folder, names[-1]) if names else {}


def table_path(out, layer, name):
    tables = released(out, layer)
    if name not in tables:
        raise NotPublished(f"{layer} has not published {name}")
    return tables[name]


def _prune(out, layer, keep):
    """Delete pointers before the last ``keep``, then the tables that none is left to show."""
    files, folder, names = _pointers(out, layer)
    old, kept = names[:-keep], names[-keep:]
    shown = {p for n in kept for p in _read(files, folder, n).values()}
    for name in old:
        paths = set(_read(files, folder, name).values())
        files.delete_file(f"{folder}/{name}")
        for path in paths - shown:
            delete_folder(path)
            parent = path.rsplit("/", 1)[0]
            if not files.get_file_info(fs.FileSelector(opened(parent)[1], allow_not_found=True)):
                delete_folder(parent)
