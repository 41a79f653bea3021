from abx.functions.columns import (clean_feature_name, hash_unit, pad_id, round6, to_cents,
                                   date_label)
from abx.functions.tails import chi2_1df_sf, normal_sf2, student_sf2

__all__ = ["clean_feature_name", "hash_unit", "pad_id", "round6", "to_cents", "date_label",
           "chi2_1df_sf", "normal_sf2", "student_sf2"]
