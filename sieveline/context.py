"""What a run shares between operators: folders, embeddings and model providers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Context:
    """``embeddings`` has (key, vec); images under the sample's id, texts under 'txt:' + id.  ``images`` has decoded
    images by resolved path (image_file, width, height and, for pixels, n_channels and data).  ``providers`` are
    callables that stand for models: image_encoder and text_encoder (DataFrame -> key, vec), text_detector
    (DataFrame -> row_idx, polygons, failed), lang_model (Column -> lang, confidence columns)."""

    spark: SparkSession
    image_root: str = ""
    work_dir: str | None = None
    embeddings: DataFrame | None = None
    images: DataFrame | None = None
    providers: dict[str, Callable] = field(default_factory=dict)
    cache_hits: int = 0
    cache_misses: int = 0

    def resolve_image(self, path: Column | str = "image_path") -> Column:
        """Where an image is: under image_root unless the path is absolute or there is no root; null for no path."""
        path = F.col(path) if isinstance(path, str) else path
        empty = F.coalesce(path, F.lit("")) == ""
        if not self.image_root:
            return F.when(~empty, path)
        root = F.lit(self.image_root.rstrip("/") + "/")
        return F.when(empty, F.lit(None)).when(path.startswith("/"), path).otherwise(F.concat(root, path))
