from .expressions import (
    after, age_group, ap_weight, days_until, discount, dot, image_path, pad_id, unit,
)

__all__ = [
    "after", "age_group", "ap_weight", "days_until", "discount", "dot", "image_path", "pad_id", "unit",
]
