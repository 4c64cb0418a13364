"""Programs: sandboxed runs, grades, edits, rollouts, replay. Python runs in workers only."""
