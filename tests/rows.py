"""Plain rows of a frame, for comparisons."""


def tuples(frame):
    return [tuple(row) for row in frame.collect()]
