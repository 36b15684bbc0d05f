"""Store clients for the delivery tests; they leave their trace in a folder
because each task has a process of its own."""

from __future__ import annotations

import json
import shutil
import uuid
from pathlib import Path


class FolderStore:
    """Keeps documents as one file per id, so an upsert replaces."""

    def __init__(self, folder, refuse=lambda d: None):
        self.folder, self.refuse = Path(folder), refuse

    def upsert(self, documents):
        (self.folder / f"call-{uuid.uuid4().hex}").write_text(str(len(documents)))
        answers = []
        for d in documents:
            why = self.refuse(d)
            if why is None:
                (self.folder / f"doc-{d['id']}").write_text(json.dumps(d))
            answers.append(why)
        return answers

    def close(self):
        (self.folder / f"closed-{uuid.uuid4().hex}").write_text("")


def open_folder(options):
    return FolderStore(options["folder"])


def open_refusing(options):
    return FolderStore(options["folder"], lambda d: "full" if d["prediction"] > 0.5 else None)


class StagingStore(FolderStore):
    """Documents wait in a folder of their token until they are published."""

    def stage(self, token, documents):
        waiting = self.folder / "staged" / token
        waiting.mkdir(parents=True, exist_ok=True)
        answers = []
        for d in documents:
            why = self.refuse(d)
            if why is None:
                (waiting / f"doc-{d['id']}").write_text(json.dumps(d))
            answers.append(why)
        return answers

    def publish(self, tokens):
        (self.folder / f"publish-{uuid.uuid4().hex}").write_text(str(len(tokens)))
        for token in tokens:
            for file in (self.folder / "staged" / token).glob("doc-*"):
                file.rename(self.folder / file.name)

    def discard(self, prefix):
        shutil.rmtree(self.folder / "staged" / prefix, ignore_errors=True)

    def count(self, dataset_type, limit):
        return min(limit, len(list(self.folder.glob("doc-*"))))

    def existing(self, dataset_type, ids):
        (self.folder / f"look-{uuid.uuid4().hex}").write_text(str(len(ids)))
        return [i for i in ids if (self.folder / f"doc-{i}").exists()]


def open_staging(options):
    return StagingStore(options["folder"])


def open_staging_refusing(options):
    return StagingStore(options["folder"], lambda d: "full" if d["prediction"] > 0.5 else None)
