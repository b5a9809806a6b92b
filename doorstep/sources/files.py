"""Folders in any store that ``pyarrow.fs`` knows: local, hdfs:, s3:, gs:."""

from pyarrow import fs


def opened(address):
    """(file system, path) of an address."""
    if address.startswith("file:"):
        address = "/" + address[5:].lstrip("/")
    if address.startswith("/"):
        return fs.LocalFileSystem(), address
    return fs.FileSystem.from_uri(address)


def delete_file(address):
    files, path = opened(address)
    files.delete_file(path)


def delete_folder(address):
    files, path = opened(address)
    if files.get_file_info(path).type == fs.FileType.Directory:
        files.delete_dir(path)


def subfolders(address):
    """The names of the folders right below an address, in order."""
    files, path = opened(address)
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(i.base_name for i in found if i.type == fs.FileType.Directory)
