"""Status and label vocabularies the marts and rules test against.

Every mart and rule takes its vocabulary as a parameter, so the same code
runs on the original Russian-language feed and on the English adapter views
built from the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Vocabulary:
    # equipment.status
    working: str
    in_repair: str
    written_off: str
    reserve: str
    # maintenance_logs.status
    maint_done: str
    maint_planned: str
    maint_overdue: str
    # inventory_results.discrepancy_type
    type_none: str
    type_missing: str
    type_moved: str
    type_surplus: str
    type_write_off: str
    # follow-up comment texts
    action_recount: str
    action_write_off: str
    action_none: str


# --- fixed values: must equal the original feed's literals --------------
# equipment status: рабочее, на ремонте, списано, резерв
# maintenance status: выполнено, запланировано, просрочено
# discrepancy type: нет, отсутствует, перемещено, лишнее, списание
# follow-up comment: Требуется пересчёт, Рассмотреть списание, (empty)
SOURCE_VOCAB = Vocabulary(
    working="рабочее",
    in_repair="на ремонте",
    written_off="списано",
    reserve="резерв",
    maint_done="выполнено",
    maint_planned="запланировано",
    maint_overdue="просрочено",
    type_none="нет",
    type_missing="отсутствует",
    type_moved="перемещено",
    type_surplus="лишнее",
    type_write_off="списание",
    action_recount="Требуется пересчёт",
    action_write_off="Рассмотреть списание",
    action_none="",
)

# --- fixed values: vocabulary of the adapter views over the driver tables --
# equipment status: working, in_repair, retired, reserve
# maintenance status: done, planned, overdue
# discrepancy type (l_returnflag): A, N, R; 'R' stands for surplus / moved
ADAPTER_VOCAB = Vocabulary(
    working="working",
    in_repair="in_repair",
    written_off="retired",
    reserve="reserve",
    maint_done="done",
    maint_planned="planned",
    maint_overdue="overdue",
    type_none="N",
    type_missing="A",
    type_moved="R",
    type_surplus="R",
    type_write_off="A",
    action_recount="recount",
    action_write_off="consider write-off",
    action_none="",
)
