import os

import pytest

from doorstep.sources import releases
from doorstep.sources.releases import NotPublished, Release, released, table_path


def publish(out, text, keep=2, layer="x"):
    with Release(out, layer, keep) as release:
        for name in ("a", "b"):
            os.makedirs(release.path(name))
            with open(f"{release.tables[name]}/data", "w") as f:
                f.write(f"{name} {text}")


def shown(out, layer="x"):
    found = {}
    for name, path in released(out, layer).items():
        with open(f"{path}/data") as f:
            found[name] = f.read()
    return found


def test_newest_release_is_shown(folder):
    with pytest.raises(NotPublished):
        table_path(folder, "x", "a")
    for i in range(12):
        publish(folder, i)
        assert shown(folder) == {"a": f"a {i}", "b": f"b {i}"}
    publish(folder, "other", layer="y")
    assert shown(folder) == {"a": "a 11", "b": "b 11"}
    with pytest.raises(NotPublished):
        table_path(folder, "x", "c")


def test_readers_keep_the_release_they_looked_up(folder):
    publish(folder, 1)
    path = table_path(folder, "x", "a")
    publish(folder, 2)
    with open(f"{path}/data") as f:
        assert f.read() == "a 1"
    publish(folder, 3)
    assert not os.path.exists(path)
    assert len(os.listdir(f"{folder}/releases")) == len(os.listdir(f"{folder}/current/x")) == 2


@pytest.mark.parametrize("at", ["create_dir", "open_output_stream", "move"])
def test_a_crash_while_publishing_shows_old_tables(folder, at, monkeypatch):
    """Whatever step of showing a release fails, both tables are the former ones."""
    publish(folder, "old")
    opened = releases.opened

    class Broken:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            if name == at:
                raise RuntimeError("lost")
            return getattr(self.files, name)

    with monkeypatch.context() as broken:
        broken.setattr(releases, "opened", lambda address: (Broken(opened(address)[0]), opened(address)[1]))
        with pytest.raises(RuntimeError):
            publish(folder, "new")
    assert shown(folder) == {"a": "a old", "b": "b old"}
    publish(folder, "newer")
    assert shown(folder) == {"a": "a newer", "b": "b newer"}


def test_a_crash_between_two_tables_shows_old_tables(folder):
    publish(folder, "old")
    with pytest.raises(KeyError):
        with Release(folder, "x") as release:
            os.makedirs(release.path("a"))
            raise KeyError("b")
    assert shown(folder) == {"a": "a old", "b": "b old"}
    assert len(os.listdir(f"{folder}/releases")) == 1


def test_shared_tables_stay_while_they_are_shown(folder):
    publish(folder, 1)
    path = table_path(folder, "x", "b")
    for i in range(4):
        with Release(folder, "x") as release:
            os.makedirs(release.path("a"))
            assert release.share("b") == path
    assert os.path.exists(path)
