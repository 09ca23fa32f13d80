"""Pages of documents as images, and the text on them, through external programs that can be exchanged.

Each program runs in a task with a time limit and gets its data through pipes; what it fails at is a row with an error.
Only an office suite needs files: they lie in a folder that the caller names, each conversion's in one of its own.
"""

from __future__ import annotations

import shutil
import subprocess
import uuid
from pathlib import Path
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame

#: Defaults (fixed values): dots an inch and slides for looking at, pages and longest side for recognition, time limits.
DPI, MAX_SLIDES, OCR_PAGES, OCR_SIDE = 120, 50, 60, 2000
CONVERT_SECONDS, RASTER_SECONDS, OCR_SECONDS = 180, 300, 60


class Rasterizer(Protocol):
    """Images (PNG) of a file's pages, in order."""

    def __call__(self, data: bytes, ext: str) -> list[bytes]: ...


class Recognizer(Protocol):
    """The text on an image."""

    def __call__(self, image: bytes) -> str: ...


_PNG = b"\x89PNG\r\n\x1a\n"


class OfficeRasterizer:
    """Slides by way of PDF (an office suite, working in the folder `work`), PDF by a renderer through pipes."""

    def __init__(
        self, work: str | None = None, most: int = MAX_SLIDES, dpi: int | None = DPI, side: int | None = None, office: str = "soffice", renderer: str = "pdftoppm"
    ):
        self.work, self.most, self.dpi, self.side, self.office, self.renderer = work, most, dpi, side, office, renderer

    def __call__(self, data: bytes, ext: str) -> list[bytes]:
        pdf = data if ext == ".pdf" else self._as_pdf(data, ext)
        size = ["-scale-to", str(self.side)] if self.side else ["-r", str(self.dpi)]
        pages = _run([self.renderer, "-png", *size, "-l", str(self.most), "-"], RASTER_SECONDS, pdf)
        return [_PNG + page for page in pages.split(_PNG)[1:]]

    def _as_pdf(self, data: bytes, ext: str) -> bytes:
        if self.work is None:
            raise ValueError("a working folder must be named to convert slides")
        own = Path(self.work) / uuid.uuid4().hex
        own.mkdir(parents=True)
        try:
            (own / f"in{ext}").write_bytes(data)
            _run([self.office, "--headless", "--convert-to", "pdf", "--outdir", str(own), str(own / f"in{ext}")], CONVERT_SECONDS)
            return (own / "in.pdf").read_bytes()
        finally:
            shutil.rmtree(own, ignore_errors=True)


class TesseractRecognizer:
    def __init__(self, langs: str = "eng+chi_sim", program: str = "tesseract"):
        self.langs, self.program = langs, program

    def __call__(self, image: bytes) -> str:
        return _run([self.program, "stdin", "stdout", "-l", self.langs], OCR_SECONDS, image).decode("utf-8", "replace")


def _run(command: list[str], seconds: int, data: bytes | None = None) -> bytes:
    if shutil.which(command[0]) is None:
        raise FileNotFoundError(f"{command[0]} is not installed")
    return subprocess.run(command, input=data, capture_output=True, timeout=seconds, check=True).stdout


def _error(exc: Exception) -> str:
    return f"{type(exc).__name__}: {exc}"[:200]


def rasterize(files: DataFrame, rasterizer: Rasterizer) -> DataFrame:
    """id, slide (from 1), name, content, error: the page images of files (id, ext, content), named as slide_images finds
    them; a file that fails gives one row with an error. Rows go on as they are made, one file's images at a time."""

    def run(batches):
        for b in batches:
            for i, ext, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                try:
                    images, error = rasterizer(raw or b"", ext), None
                except Exception as exc:  # noqa: BLE001
                    images, error = [None], _error(exc)
                n = range(1, len(images) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(images), pa.string()), pa.array([None if error else k for k in n], pa.int32()),
                     pa.array([None if error else f"{i}/slide-{k:02d}.png" for k in n], pa.string()), pa.array(images, pa.binary()), pa.array([error] * len(images), pa.string())],
                    names=["id", "slide", "name", "content", "error"],
                )

    return files.select("id", "ext", "content").mapInArrow(run, "id string, slide int, name string, content binary, error string")


def recognise(files: DataFrame, rasterizer: Rasterizer, recognizer: Recognizer) -> DataFrame:
    """id, ocr_text, ocr_error of files (id, ext, content): the pages' texts joined by blank lines. A page that fails is
    left out; a file none of whose pages can be read has an error and no text."""

    def run(batches):
        for b in batches:
            ids, texts, errors = [], [], []
            for i, ext, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                pages, error = [], None
                try:
                    for image in rasterizer(raw or b"", ext):
                        try:
                            pages.append(recognizer(image).strip())
                        except Exception as exc:  # noqa: BLE001
                            error = _error(exc)
                except Exception as exc:  # noqa: BLE001
                    error = _error(exc)
                text = "\n\n".join(p for p in pages if p)
                ids.append(i)
                texts.append(text or None)
                errors.append(None if text else error or "no text on any page")
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["id", "ocr_text", "ocr_error"])

    return files.select("id", "ext", "content").mapInArrow(run, "id string, ocr_text string, ocr_error string")
