"""The Python functions that frames hand to Spark, to be run in the test itself."""


def recorded(spark, monkeypatch):
    """A list that each function given to ``mapInArrow`` is added to."""
    kind, functions = type(spark.range(1)), []
    original = kind.mapInArrow

    def taken(self, function, *rest, **named):
        functions.append(function)
        return original(self, function, *rest, **named)

    monkeypatch.setattr(kind, "mapInArrow", taken)
    return functions
