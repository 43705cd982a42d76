"""Writers and the merge rules that decide what a target table becomes."""
