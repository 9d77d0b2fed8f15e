"""Operations of a training-data pipeline: each module holds one operator with its own interface."""
