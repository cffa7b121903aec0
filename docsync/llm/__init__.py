"""Operations of large-scale training-data pipelines."""
