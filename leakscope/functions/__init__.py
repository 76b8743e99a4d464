from leakscope.functions.rounding import round_half_up, round_sql
from leakscope.functions.severity import (alert_message_expr, binary_label_expr,
                                          combined_severity_expr, detection_source_expr,
                                          dual_message_expr, severity_expr)

__all__ = ["round_half_up", "round_sql", "severity_expr", "alert_message_expr",
           "combined_severity_expr", "detection_source_expr", "dual_message_expr",
           "binary_label_expr"]
