from .events import load_new_event_files

__all__ = ["load_new_event_files"]
