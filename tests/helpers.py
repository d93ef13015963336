import contextlib
import io
import os

from pyspark.sql import DataFrame


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is None, str(v)) for v in row])


def plan_of(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as Spark prints it; the final one if the frame has been run."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def text_files(folder, **files: list[str]) -> str:
    """A folder of text files, one per keyword, one line per item."""
    os.makedirs(folder, exist_ok=True)
    for name, lines in files.items():
        with open(os.path.join(folder, f"{name}.txt"), "w", encoding="utf-8") as file:
            file.writelines(f"{line}\n" for line in lines)
    return str(folder)
