from gainkit.streaming.score_stream import running_accuracy, score_stream

__all__ = ["score_stream", "running_accuracy"]
