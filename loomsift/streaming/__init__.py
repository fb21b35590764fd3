"""loomsift.streaming"""
