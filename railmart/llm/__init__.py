"""Operations of a training-data pipeline: one module per operator, `queries` names them. Nothing else in the library imports this."""
