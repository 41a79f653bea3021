from abx.streaming.stream import (run_available, stream_exposures, stream_user_day_metrics,
                                  stream_userlog)

__all__ = ["run_available", "stream_exposures", "stream_user_day_metrics", "stream_userlog"]
